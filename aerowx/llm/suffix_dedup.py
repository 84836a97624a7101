"""Passages that repeat across documents, found with a sparse suffix array.

Suffixes start only where a minimiser stands: the smallest hash of ``k`` words in a window
of ``min_words`` words. Equal passages of that length have a minimiser in common, whatever
surrounds them. Suffixes that share their first ``k`` words with another document are kept
with the words around them, sorted, and compared with their neighbours: the longest run in
common with a neighbour bounds how far a match reaches to the right. Up to there it is
extended to the left word by word, which settles each window of ``min_words`` words.

Surroundings that are equal are one row with the smallest and largest document that has
them, so a passage with very many copies costs no more than one with two. Sorted rows are
dealt in ranges that may cut a gram, and a task holds ``MOST_ROWS`` of one gram and a batch at
most. Where a gram is cut, its windows are not settled in the task but by a groupBy.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import enrich
from ..session import durable
from .runs import run_starts, whole_runs
from .shared import written
from .words import grams, hash_words, mixed, text_words

MIN_WORDS = 50
GRAM = 8
#: Rows of one gram that a task settles by itself.
MOST_ROWS = 4096


def _shape(min_words: int, gram: int) -> int:
    """Windows of ``min_words`` words that can hold a gram: so many starts."""
    if not 1 <= gram <= min_words or min_words - gram + 1 > 62:
        raise ValueError("need 1 <= gram <= min_words, and at most 62 gram places in a window")
    return min_words - gram + 1


def minimisers(words: np.ndarray, min_words: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the smallest gram of every window, each place once."""
    around = min_words - gram + 1
    if len(words) < min_words:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = grams(words, gram, 3)
    lowest = np.lib.stride_tricks.sliding_window_view(hashes, around).argmin(axis=1)
    places = np.unique(lowest + np.arange(len(lowest)))
    return places, hashes[places]


def _suffixes(min_words: int, gram: int):
    def suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, places, hashes = [], [], []
            for doc, words in zip(batch["doc_id"], text_words(batch["text"])):
                at, found = minimisers(words, min_words, gram)
                ids.append(np.full(len(at), doc, np.int64))
                places.append(at)
                hashes.append(found)
            if ids:
                yield pd.DataFrame(
                    {
                        "gram": np.concatenate(hashes).view(np.int64),
                        "doc_id": np.concatenate(ids),
                        "place": np.concatenate(places).astype(np.int32),
                    }
                )

    return suffixes


_POWERS = np.cumprod(np.full(256, 0x9FB21C651E98DF25, np.uint64), dtype=np.uint64)
_INVERSE = np.cumprod(np.full(256, pow(0x9FB21C651E98DF25, -1, 1 << 64), np.uint64), dtype=np.uint64)


def _surroundings(min_words: int, gram: int):
    """The words around each kept suffix as 32-bit numbers, 0 beyond the text's ends.

    First the suffix itself to the right, then what precedes it, read backwards: in the order
    of these rows, neighbours share the most words to the right.
    """
    side = min_words - gram

    def surroundings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tables, found, ids, at = [], [], [], []
            for doc, kept, words in zip(batch["doc_id"], batch["kept"], text_words(batch["text"])):
                places = np.array([k["place"] for k in kept], np.int64)
                wanted = np.array([k["gram"] for k in kept], np.int64)
                hashes = grams(words, gram, 3).view(np.int64)
                here = places < len(hashes)
                places, wanted = places[here], wanted[here]
                same = hashes[places] == wanted
                places, wanted = places[same], wanted[same]
                if not len(places):
                    continue
                small = np.maximum((mixed(words, 11) >> np.uint64(32)).astype(np.uint32), 1)
                around = np.lib.stride_tricks.sliding_window_view(np.pad(small, side), min_words + side)[places]
                tables.append(np.concatenate((around[:, side:], around[:, :side][:, ::-1]), axis=1))
                found.append(wanted)
                ids.append(np.full(len(places), doc, np.int64))
                at.append(places.astype(np.int32))
            if not tables:
                continue
            table = np.concatenate(tables)
            digest = mixed((table * _POWERS[: table.shape[1]]).sum(axis=1, dtype=np.uint64), 5)
            yield pd.DataFrame(
                {
                    "gram": np.concatenate(found),
                    "around": digest.view(np.int64),
                    "doc_id": np.concatenate(ids),
                    "place": np.concatenate(at),
                    "words": [r.tobytes() for r in table],
                }
            )

    return surroundings


def live_windows(
    grams_: np.ndarray, table: np.ndarray, many: np.ndarray, min_words: int, gram: int, cut: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and keys of the windows around sorted suffixes that may occur twice.

    ``many`` tells rows that two documents have. Where the rows are ``cut`` out of more, the
    first and last may share all with neighbours that aren't here. Equal windows have one key.
    """
    starts = min_words - gram + 1
    # The longest run shared to the right is shared with a neighbour.
    right = table[:, :min_words]
    equal = (right[1:] == right[:-1]) & (right[1:] != 0)
    common = np.where(equal.all(axis=1), min_words, equal.argmin(axis=1)) * (grams_[1:] == grams_[:-1])
    reach = np.maximum(np.append(common, 0), np.append(0, common))
    if cut:
        reach[[0, -1]] = min_words
    # A window ends some words to the right; to the left the match is extended word by word,
    # all starts at once, by one running sum over the row.
    row = np.concatenate((table[:, min_words:][:, ::-1], right), axis=1).astype(np.uint64)
    total = np.concatenate(
        (np.zeros((len(row), 1), np.uint64), np.cumsum(row * _POWERS[: row.shape[1]], axis=1, dtype=np.uint64)), axis=1
    )
    keys = (total[:, min_words:] - total[:, :starts]) * _INVERSE[:starts]
    ends = np.arange(starts) + gram
    whole = (row[:, :starts] != 0) & (row[:, min_words - 1 :] != 0)
    live = whole & (many[:, None] | (ends <= reach[:, None]))
    at, start = np.nonzero(live)
    key = mixed(keys[at, start] + np.uint64(0x9E3779B97F4A7C15) * start.astype(np.uint64)) ^ mixed(
        grams_[at].view(np.uint64), 17
    )
    return at, start, key


def repeated_windows(
    grams_: np.ndarray, table: np.ndarray, low: np.ndarray, high: np.ndarray, min_words: int, gram: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which windows around sorted suffixes occur in two documents, as bits from the left.

    ``low`` and ``high`` are the smallest and largest document that has each row. Also
    gives the smallest and largest document over the repeated windows of each row.
    """
    at, start, key = live_windows(grams_, table, low != high, min_words, gram)
    bits = np.zeros(len(table), np.int64)
    first, last = low.copy(), high.copy()
    if len(at):
        order = np.argsort(key, kind="stable")
        cuts = run_starts(key[order])
        sizes = np.diff(np.append(cuts, len(order)))
        least, most = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
        least[order] = np.repeat(np.minimum.reduceat(low[at][order], cuts), sizes)
        most[order] = np.repeat(np.maximum.reduceat(high[at][order], cuts), sizes)
        hit = least != most
        at, start, least, most = at[hit], start[hit], least[hit], most[hit]
        np.bitwise_or.at(bits, at, np.int64(1) << start.astype(np.int64))
        np.minimum.at(first, at, least)
        np.maximum.at(last, at, most)
    return bits, first, last


def _pieces(batches: Iterator[pd.DataFrame], most: int) -> Iterator[tuple[pd.DataFrame, bool]]:
    """Frames of sorted rows, and whether a frame is part of one gram that is cut.

    The first and last gram of a task may go on in another, and one of ``most`` rows or more
    is given out in parts. All other frames hold whole grams. Holds a batch and ``most`` rows.
    """
    held, cut = None, None
    for batch in batches:
        if len(batch) == 0:
            continue
        cut = batch["gram"].iloc[0] if cut is None else cut
        frame = batch if held is None else pd.concat([held, batch], ignore_index=True)
        starts = run_starts(frame["gram"].to_numpy())
        end = starts[-1]
        if end:
            lead = starts[1] if frame["gram"].iloc[0] == cut else 0
            if lead:
                yield frame.iloc[:lead], True
            if end > lead:
                yield frame.iloc[lead:end], False
        held = frame.iloc[end:]
        if len(held) >= most:
            cut = held["gram"].iloc[0]
            yield held, True
            held = None
    if held is not None:
        yield held, True


def _extend(min_words: int, gram: int):
    """Settled rows with their repeated windows; rows of cut grams with keys of windows instead.

    Of the latter, bits tell the windows that have a key, first and last are the smallest and
    largest document that has the row, and piece is the first row of those held together. Each
    distinct key of a piece follows as one row of its own (``key`` set, ``keys`` empty), with
    the smallest and largest document over the rows that have it.
    """
    most, starts = MOST_ROWS, min_words - gram + 1

    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        width = gram + 2 * (min_words - gram)
        for frame, cut in _pieces(batches, most):
            low, high = frame["low"].to_numpy(), frame["high"].to_numpy()
            table = np.frombuffer(b"".join(frame["words"]), np.uint32).reshape(len(frame), width)
            hashes = frame["gram"].to_numpy()
            if cut:
                at, start, key = live_windows(hashes, table, low != high, min_words, gram, cut)
                bits, keys = np.zeros(len(frame), np.int64), np.zeros((len(frame), starts), np.int64)
                np.bitwise_or.at(bits, at, np.int64(1) << start.astype(np.int64))
                keys[at, start] = key.view(np.int64)
                piece = frame["around"].iloc[0]
                out = frame[["gram", "around"]].assign(bits=bits, first=low, last=high, piece=piece, keys=list(keys), key=None)
                yield out[out["bits"] != 0]
                # Equal windows of the piece are one row, with the smallest and largest document.
                if len(at):
                    order = np.argsort(key, kind="stable")
                    cuts = run_starts(key[order])
                    yield pd.DataFrame(
                        {
                            "gram": frame["gram"].iloc[0],
                            "around": None,
                            "bits": 0,
                            "first": np.minimum.reduceat(low[at][order], cuts),
                            "last": np.maximum.reduceat(high[at][order], cuts),
                            "piece": piece,
                            "keys": None,
                            "key": key[order][cuts].view(np.int64),
                        }
                    )
            else:
                bits, first, last = repeated_windows(hashes, table, low, high, min_words, gram)
                out = frame[["gram", "around"]].assign(bits=bits, first=first, last=last, piece=0, keys=None, key=None)
                yield out[out["bits"] != 0]

    return extend


def _resolve(rows: pd.DataFrame, shared: pd.DataFrame) -> pd.DataFrame:
    """Rows of one piece with those of their windows that are shared."""
    shared = shared.sort_values("key")
    keys, known = np.stack(rows["keys"].to_numpy()), shared["key"].to_numpy()
    bits, first, last = np.zeros(len(rows), np.int64), rows["first"].to_numpy().copy(), rows["last"].to_numpy().copy()
    if len(known):
        at, start = np.nonzero((rows["bits"].to_numpy()[:, None] >> np.arange(keys.shape[1])) & 1)
        place = np.minimum(np.searchsorted(known, keys[at, start]), len(known) - 1)
        hit = known[place] == keys[at, start]
        at, start, place = at[hit], start[hit], place[hit]
        np.bitwise_or.at(bits, at, np.int64(1) << start.astype(np.int64))
        np.minimum.at(first, at, shared["low"].to_numpy()[place])
        np.maximum.at(last, at, shared["high"].to_numpy()[place])
    out = rows[["gram", "around"]].assign(bits=bits, first=first, last=last)
    return out[out["bits"] != 0]


def _settled(found: DataFrame) -> DataFrame:
    """What ``_extend`` gives, with the windows of cut grams settled: those two documents have.

    A window that many rows of a piece have comes once from the task, so that what is grouped
    and joined grows with the distinct windows, not with rows times windows.
    """
    cut = found.where("keys IS NOT NULL").drop("key")
    windows = found.where("key IS NOT NULL").groupBy("gram", "piece", "key")
    windows = durable(windows.agg(F.min("first").alias("low"), F.max("last").alias("high")))
    extent = windows.groupBy("gram", "key").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    shared = durable(extent.where("low <> high"))
    hits = enrich(windows.select("gram", "piece", "key"), shared, ["gram", "key"], "inner", spread_by=["piece"])
    hits = hits.select(F.col("gram").alias("of_gram"), F.col("piece").alias("of_piece"), "key", "low", "high")
    opened = cut.groupBy("gram", "piece").cogroup(hits.groupBy("of_gram", "of_piece"))
    opened = opened.applyInPandas(_resolve, "gram long, around long, bits long, first long, last long")
    return found.where("keys IS NULL AND key IS NULL").drop("keys", "piece", "key").unionByName(opened)


def _spans(min_words: int, gram: int):
    side = min_words - gram

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["doc_id"]):
            doc, place, bits = (frame[c].to_numpy() for c in ("doc_id", "place", "bits"))
            on = ((bits[:, None] >> np.arange(side + 1)) & 1).astype(bool)
            row, shift = np.nonzero(on)
            start = place[row].astype(np.int64) - side + shift
            order = np.lexsort((start, doc[row]))
            row, start = row[order], start[order]
            owner = doc[row]
            fresh = np.ones(len(start), bool)
            # A window begins a span unless it touches the one before it in its document.
            fresh[1:] = (owner[1:] != owner[:-1]) | (start[1:] > start[:-1] + min_words)
            at = np.flatnonzero(fresh)
            if not len(at):
                continue
            ends = np.append(at[1:], len(start)) - 1
            least = np.minimum.reduceat(frame["first"].to_numpy()[row], at)
            most = np.maximum.reduceat(frame["last"].to_numpy()[row], at)
            yield pd.DataFrame(
                {
                    "doc_id": owner[at],
                    "start_word": start[at],
                    "n_words": start[ends] + min_words - start[at],
                    "other_doc_id": np.where(least != owner[at], least, most),
                    "first_doc_id": least,
                }
            )

    return spans


def repeated_spans(
    docs: DataFrame, min_words: int = MIN_WORDS, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every run of words of which each part of ``min_words`` words occurs in another document.

    Words are runs of characters other than space and \\t to \\r, A-Z lowered. Returns one row
    per run: doc_id, start_word (0-based), n_words, other_doc_id (some other document with
    a part of it: the smallest, or the largest where this one is the smallest), first_doc_id
    (the smallest document with a part of it). Runs of one document that overlap or touch
    are one. Repeats inside one document alone don't count.

    NULL, empty and short texts have no runs; rows with a NULL id are left out. Rows that
    share an id count as one document, and each gives its own runs, merged. Other columns
    are ignored; an empty table gives an empty result.
    """
    _shape(min_words, gram)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    suffixes = written(rows.mapInPandas(_suffixes(min_words, gram), "gram long, doc_id long, place int"), "suffixes")
    extent = suffixes.groupBy("gram").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = durable(extent.where("low <> high").select("gram"))
    kept = suffixes.join(shared, "gram").groupBy("doc_id").agg(F.collect_list(F.struct("place", "gram")).alias("kept"))
    around = written(
        rows.join(kept, "doc_id").mapInPandas(
            _surroundings(min_words, gram), "gram long, around long, doc_id long, place int, words binary"
        ),
        "surroundings",
    )
    distinct = around.groupBy("gram", "around").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.first("words").alias("words")
    )
    found = durable(
        distinct.repartitionByRange("gram", "words")
        .sortWithinPartitions("gram", "words")
        .mapInPandas(
            _extend(min_words, gram),
            "gram long, around long, bits long, first long, last long, piece long, keys array<long>, key long",
        )
    )
    hits = around.select("gram", "around", "doc_id", "place").join(_settled(found), ["gram", "around"])
    dealt = hits.select("doc_id", "place", "bits", "first", "last").repartition("doc_id").sortWithinPartitions("doc_id")
    return dealt.mapInPandas(
        _spans(min_words, gram),
        "doc_id long, start_word long, n_words long, other_doc_id long, first_doc_id long",
    )


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch["text"], batch["spans"]):
            if text is None or spans is None or not len(spans):
                texts.append(text)
                continue
            data = text.encode("utf-8", "surrogatepass")
            starts, ends, _ = hash_words(data)
            out, at = [], 0
            for span in sorted(spans, key=lambda s: s["start_word"]):
                first, last = span["start_word"], span["start_word"] + span["n_words"] - 1
                if last < len(starts):
                    out.append(data[at : starts[first]])
                    at = ends[last]
            texts.append(b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass"))
        yield batch[["doc_id"]].assign(text=texts)


def without_repeats(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_id, text) with the runs cut out that a document of a smaller id has too."""
    late = spans.where("first_doc_id < doc_id")
    by_doc = late.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "n_words")).alias("spans"))
    return docs.select("doc_id", "text").join(by_doc, "doc_id", "left").mapInPandas(_cut, "doc_id long, text string")
