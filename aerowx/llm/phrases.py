"""Phrases whose words stand together more often than their parts suggest, per language.

Every n-gram of one to ``longest`` words gets a Rabin-Karp fingerprint: word hashes are summed
with the powers of a base into prefix polynomials, and a run's fingerprint is the difference
of two prefixes times a power. Texts are written once, in numbered blocks of bounded size.

1. Each block sends its fingerprints, cut to cells, with its own counts, to the shuffle. A
   share of the cells adds them up over all blocks and answers each block with those of its
   cells that reach the minimum; the number of cells follows the size of the texts. The
   answer also names one block for each such cell, the pointer to an occurrence.
2. Each block looks the cells up among its n-grams, groups the few that are left by whole
   fingerprint and compares every occurrence with the first one word by word. It sends the
   fingerprints, each with a second one of other hashes and its count, and the block that was
   named sends the phrase itself. Sums over pairs of fingerprints are the phrases' counts.
3. A frequent phrase whose cell is named after another phrase is spelled in a last look at one
   block that holds it.

Parts and longer phrases of a frequent phrase are joins on the table of frequent phrases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import enrich
from ..session import durable
from .runs import run_starts, slices, whole_runs
from .shared import LOWER, UPPER, written
from .words import _powers, hash_words, mixed
from .words import _tables as powers

#: Characters that end a piece, besides those from \\x0A to \\x0D (fixed values).
ENDS = ".,;:!?"
_BREAKS = ENDS + "\n\v\f\r"
_TABLE = bytes.maketrans((UPPER + _BREAKS + "\t").encode(), (LOWER + "\n" * len(_BREAKS) + " ").encode())
BLOCK_BYTES = 3 << 20
#: Text whose fingerprints one share of the cells adds up, over all blocks.
SHARE_BYTES = 4 << 20
#: Pieces that the rows of a language are dealt over before they are ranked together.
RANK_PIECES = 64

#: Words above this many bytes are digested one by one for the second fingerprint.
LONG_WORD = 256
_REACH = 1 << 17
_SECOND = 0xC2B2AE3D27D4EB4F
_second_up = _powers(_SECOND, _REACH + LONG_WORD + 1)
_second_down = _powers(pow(_SECOND, -1, 1 << 64), _REACH + LONG_WORD + 1)


def second_hashes(data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words that don't depend on those of ``hash_words``."""
    out = np.empty(len(starts), np.uint64)
    size = ends - starts
    for low in range(0, len(data), _REACH):
        a, b = np.searchsorted(starts, (low, low + _REACH))
        buffer = np.frombuffer(data[low : low + _REACH + LONG_WORD], np.uint8).astype(np.uint64) + np.uint64(1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(buffer * _second_up[: len(buffer)])))
        first, last = starts[a:b] - low, np.minimum(ends[a:b] - low, len(buffer))
        out[a:b] = (total[last] - total[first]) * _second_down[first]
    out = mixed(out + size.astype(np.uint64) * np.uint64(_SECOND), 5)
    for k in np.flatnonzero(size > LONG_WORD).tolist():
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return out


class Block:
    """The words of many UTF-8 texts in a row, with the piece and the language each stands in."""

    def __init__(self, texts, langs, bits: int = 64):
        self.data = b"\n".join(texts).translate(_TABLE)
        buffer = np.frombuffer(self.data, np.uint8)
        self.starts, self.ends, self.words = hash_words(self.data)
        self.piece = np.cumsum(buffer == 10, dtype=np.int64)[self.starts] if len(buffer) else np.empty(0, np.int64)
        self.names, code = np.unique(np.asarray(langs, object).astype(str), return_inverse=True)
        text = np.searchsorted(np.cumsum([0] + [len(t) + 1 for t in texts]), self.starts, side="right") - 1
        self.lang = code[text]
        seeds = [int.from_bytes(hashlib.blake2b(n.encode(), digest_size=8).digest(), "little") for n in self.names]
        self.seed = np.array(seeds, np.uint64)[self.lang]
        self.mask = np.uint64((1 << bits) - 1)
        up, self.down = powers(len(self.words) + 1)
        self.up = up[: len(self.words)]
        self.prefix = self._prefix(self.words)

    def _prefix(self, words: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * self.up)))

    def _runs(self, prefix: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
        return mixed(((prefix[place + n] - prefix[place]) * self.down[place] ^ self.seed[place]) & self.mask, n)

    def fingerprints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the runs of ``n`` words inside one piece, and their fingerprints."""
        if len(self.words) < n:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        place = np.flatnonzero(self.piece[n - 1 :] == self.piece[: len(self.words) - n + 1])
        return place, self._runs(self.prefix, place, n)

    def second(self):
        """A function from places and n to the second fingerprints."""
        prefix = self._prefix(second_hashes(self.data, self.starts, self.ends))
        return lambda place, n: mixed((prefix[place + n] - prefix[place]) * self.down[place] ^ self.seed[place], n + 64)

    def word_ids(self) -> np.ndarray:
        """Numbers of the words, equal only where all bytes are."""
        order = np.argsort(self.words, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = self.words[order[1:]] != self.words[order[:-1]]
        again = np.flatnonzero(~new)
        if not self._same_bytes(order[again - 1], order[again]):
            known: dict[bytes, int] = {}
            spans = zip(self.starts.tolist(), self.ends.tolist())
            return np.array([known.setdefault(self.data[a:b], len(known)) for a, b in spans], np.int64)
        ids = np.empty(len(order), np.int64)
        ids[order] = np.cumsum(new)
        return ids

    def _same_bytes(self, a: np.ndarray, b: np.ndarray) -> bool:
        size = self.ends[a] - self.starts[a]
        if (size != self.ends[b] - self.starts[b]).any():
            return False
        eight = np.lib.stride_tricks.sliding_window_view(np.frombuffer(self.data + bytes(8), np.uint8), 8)
        at = 0
        while len(size):
            x = eight[self.starts[a] + at].view(np.uint64).ravel() ^ eight[self.starts[b] + at].view(np.uint64).ravel()
            left = np.minimum(8, size - at).astype(np.uint64)
            if (x << (np.uint64(8) * (np.uint64(8) - left))).any():
                return False
            at += 8
            more = size > at
            a, b, size = a[more], b[more], size[more]
        return True

    def text(self, place: int) -> str:
        return self.data[self.starts[place] : self.ends[place]].decode("utf-8", "replace")


def _numbered(block_bytes: int):
    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            numbers = []
            for size in pc.binary_length(batch.column("text")).to_pylist():
                if held and held + size > block_bytes:
                    block, held = block + 1, 0
                held += size + 1
                numbers.append(block)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "block"])

    return numbered


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes], list[str]]]:
    """Number, texts and languages of each block; its rows stand together."""
    block, texts, langs = None, [], []
    for batch in batches:
        numbers = batch.column("block").to_numpy()
        starts = run_starts(numbers)
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(numbers)]):
            if texts and numbers[a] != block:
                yield block, texts, langs
                texts, langs = [], []
            block = int(numbers[a])
            texts += batch.column("text").slice(a, b - a).cast(pa.binary()).to_pylist()
            langs += batch.column("lang").slice(a, b - a).to_pylist()
    if texts:
        yield block, texts, langs


def _pack(values: np.ndarray) -> bytes:
    """Numbers at the width that the largest needs, first bytes first: empty ones compress to nothing."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w))
    narrow = np.ascontiguousarray(values, f"u{width}")
    return bytes([width]) + narrow.view(np.uint8).reshape(-1, width).T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    return planes.T.copy().view(f"u{width}").ravel().astype(np.uint64)


def _cells(keys: np.ndarray, bits: int) -> np.ndarray:
    return keys >> np.uint64(64 - bits)


def _by_share(sorted_keys: np.ndarray, bits: int, shares: int) -> list[tuple[int, int, int]]:
    """Number, start and end of each share of the keys; shares are ranges of equal width."""
    borders = (np.arange(1, shares, dtype=np.float64) * (2.0**bits / shares)).astype(np.uint64)
    cuts = [0, *np.searchsorted(sorted_keys, borders).tolist(), len(sorted_keys)]
    return [(k, x, y) for k, (x, y) in enumerate(zip(cuts[:-1], cuts[1:])) if x < y]


def _tally(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of several arrays, sorted, and how often each stands in them."""
    flat = np.concatenate(parts)
    parts.clear()
    flat.sort()
    starts = run_starts(flat)
    return flat[starts], np.diff(np.append(starts, len(flat)))


def _send(longest: int, bits: int, shares: int, mask: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, texts, langs in _blocks(batches):
            block = Block(texts, langs, mask)
            cells, counts = _tally([_cells(block.fingerprints(n)[1], bits) for n in range(1, longest + 1)])
            parts = _by_share(cells, bits, shares)
            yield pa.RecordBatch.from_pydict(
                {
                    "share": pa.array([k for k, _, _ in parts], pa.int64()),
                    "block": pa.array([number] * len(parts), pa.int64()),
                    "cells": pa.array([_pack(np.diff(cells[x:y], prepend=np.uint64(0))) for _, x, y in parts], pa.binary()),
                    "counts": pa.array([_pack(counts[x:y]) for _, x, y in parts], pa.binary()),
                }
            )

    return send


def _sums(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of rows by their keys (one or two columns), starts of equal keys in it, sums of their counts."""
    order = np.lexsort(keys[::-1]) if keys.ndim == 2 else np.argsort(keys, kind="stable")
    starts = run_starts(*(keys[:, order] if keys.ndim == 2 else [keys[order]]))
    return order, starts, np.add.reduceat(counts[order], starts)


def _answer(least: int):
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["share"]):
            for a, b in slices(frame, ["share"]):
                part = frame.iloc[a:b].sort_values("block")
                cells = [np.cumsum(_unpack(x), dtype=np.uint64) for x in part["cells"]]
                flat = np.concatenate(cells)
                order, starts, sums = _sums(flat, np.concatenate([_unpack(x) for x in part["counts"]]))
                often, named = np.empty(len(flat), bool), np.zeros(len(flat), np.uint64)
                often[order] = np.repeat(sums >= least, np.diff(np.append(starts, len(flat))))
                named[order[starts]] = 1  # the sort is stable, so this is the smallest block
                ends = np.cumsum([0] + [len(c) for c in cells])
                rows = [
                    (block, _pack(c[often[x:y]]), _pack(named[x:y][often[x:y]]))
                    for block, c, x, y in zip(part["block"], cells, ends[:-1], ends[1:])
                    if often[x:y].any()
                ]
                yield pd.DataFrame(rows, columns=["block", "cells", "named"])

    return answer


def _grouped(block: Block, ids: np.ndarray, place: np.ndarray, prints: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First of each equal run of words among ``place``, and how many; fingerprints are checked against the words."""
    _, first, group, count = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
    lead = place[first][group]
    same = block.lang[place] == block.lang[lead]
    for k in range(n):
        same &= ids[place + k] == ids[lead + k]
    if not same.all():
        runs = np.column_stack([block.lang[place]] + [ids[place + k] for k in range(n)])
        _, first, count = np.unique(runs, axis=0, return_index=True, return_counts=True)
    return first, count


def _spelled(block: Block, ids: np.ndarray, places: np.ndarray, n: int, known: dict[int, str]) -> list[str]:
    """The phrases at some places; words are decoded once."""
    phrases = []
    for p in places.tolist():
        parts = []
        for q in range(p, p + n):
            if (word := known.get(i := int(ids[q]))) is None:
                word = known[i] = block.text(q)
            parts.append(word)
        phrases.append(" ".join(parts))
    return phrases


_FOUND = "share long, block long, prints binary, seconds binary, counts binary, at binary, lang array<string>, n_words array<int>, phrase array<string>"
_COUNTED = "print long, second long, f long, block long, lang string, n_words int, phrase string"


def _encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def _find(longest: int, bits: int, shares: int, mask: int):
    names = [c.split()[0] for c in _FOUND.split(", ")]

    def find(key, docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if len(docs) == 0:
            return pd.DataFrame({c: [] for c in names})
        block = Block(_encoded(docs["text"]), docs["lang"], mask)
        # All words of a language count as a phrase of no words, under the language's own number.
        langs, first, count = np.unique(block.lang, return_index=True, return_counts=True)
        found = [(block.seed[first], np.zeros(len(first), np.uint64), count.astype(np.uint64), np.ones(len(first), bool))]
        spelled = [[(block.names[k], 0, "") for k in langs]]
        if len(back):
            often = np.concatenate([_unpack(x) for x in back["cells"]])
            order = np.argsort(often)
            often, named = often[order], np.concatenate([_unpack(x) for x in back["named"]])[order] > 0
            ids, second, known = block.word_ids(), block.second(), {}
            for n in range(1, longest + 1):
                place, prints = block.fingerprints(n)
                at = np.minimum(np.searchsorted(often, _cells(prints, bits)), len(often) - 1)
                hit = np.flatnonzero(often[at] == _cells(prints, bits))
                first, count = _grouped(block, ids, place[hit], prints[hit], n)
                first = hit[first]
                mine = named[at[first]]
                found.append((prints[first], second(place[first], n), count.astype(np.uint64), mine))
                owned = place[first[mine]]
                spelled.append([(block.names[k], n, p) for k, p in zip(block.lang[owned], _spelled(block, ids, owned, n, known))])
        prints, seconds, counts, mine = (np.concatenate(x) for x in zip(*found))
        labels = np.empty(len(prints), object)
        labels[mine] = pd.Series([x for part in spelled for x in part], dtype=object).to_numpy()
        order = np.argsort(prints, kind="stable")
        prints, seconds, counts, mine, labels = (x[order] for x in (prints, seconds, counts, mine, labels))
        rows = []
        for share, x, y in _by_share(prints, 64, shares):
            at = np.flatnonzero(mine[x:y])
            named_here = list(zip(*labels[x:y][at])) or [(), (), ()]
            gaps = np.diff(prints[x:y], prepend=np.uint64(0))
            numbers = (_pack(gaps), _pack(seconds[x:y]), _pack(counts[x:y]), _pack(at))
            rows.append((share, int(docs["block"].iloc[0]), *numbers, *map(list, named_here)))
        return pd.DataFrame(rows, columns=names)

    return find


def _count(least: int):
    names = [c.split()[0] for c in _COUNTED.split(", ")]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["share"]):
            for a, b in slices(frame, ["share"]):
                part = frame.iloc[a:b].sort_values("block")
                prints = [np.cumsum(_unpack(x), dtype=np.uint64) for x in part["prints"]]
                sizes = [len(p) for p in prints]
                keys = np.stack([np.concatenate(prints), np.concatenate([_unpack(x) for x in part["seconds"]])])
                order, starts, sums = _sums(keys, np.concatenate([_unpack(x) for x in part["counts"]]))
                blocks = np.repeat(part["block"].to_numpy(), sizes)
                group = np.empty(len(order), np.int64)
                group[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
                label = {}
                for low, at, *spelled in zip(
                    np.cumsum([0] + sizes[:-1]).tolist(), part["at"], part["lang"], part["n_words"], part["phrase"]
                ):
                    label.update(zip(group[low + _unpack(at).astype(np.int64)].tolist(), zip(*spelled)))
                rows = [
                    (*keys[:, order[s]].view(np.int64).tolist(), total, blocks[order[s]], *spelled)
                    for g, (s, total) in enumerate(zip(starts.tolist(), sums.tolist()))
                    if (spelled := label.get(g, (None, None, None)))[1] == 0 or total >= least
                ]
                yield pd.DataFrame(rows, columns=names).astype({"n_words": "Int64"})

    return count


def _last_look(longest: int, mask: int):
    names = [c.split()[0] for c in _COUNTED.split(", ")]

    def last_look(key, docs: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        rows: dict = {}
        if len(docs) and len(wanted):
            block = Block(_encoded(docs["text"]), docs["lang"], mask)
            ids, second = block.word_ids(), block.second()
            asked = {(p, s): (f, b) for p, s, f, b in wanted[names[:4]].itertuples(index=False)}
            seek = wanted["print"].to_numpy().view(np.uint64)
            for n in range(1, longest + 1):
                place, prints = block.fingerprints(n)
                hit = np.isin(prints, seek)
                place, prints = place[hit], prints[hit]
                pairs = zip(prints.view(np.int64).tolist(), second(place, n).view(np.int64).tolist())
                for pair, p in zip(pairs, place.tolist()):
                    if pair in asked and pair not in rows:
                        phrase = _spelled(block, ids, np.array([p]), n, {})[0]
                        rows[pair] = (*pair, *asked[pair], block.names[block.lang[p]], n, phrase)
        return pd.DataFrame(list(rows.values()), columns=names)

    return last_look


def frequent_phrases(
    docs: DataFrame,
    least: int,
    longest: int,
    lang_col: str = "lang",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    fingerprint_bits: int = 64,
) -> DataFrame:
    """(lang, n_words, phrase, f): runs of 1 to ``longest`` words that occur ``least`` times or more.

    Rows of 0 words hold all word occurrences of a language. Counts are exact whatever
    ``fingerprint_bits`` is; fewer bits only make more work (tests do so).
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    texts = written(rows.mapInArrow(_numbered(block_bytes), "lang string, text string, block long"), "phrase-texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shares = max(1, -(-size // SHARE_BYTES))
    bits = max(8, (2 * size).bit_length())
    sent = texts.mapInArrow(
        _send(longest, bits, shares, fingerprint_bits), "share long, block long, cells binary, counts binary"
    )
    back = (
        sent.repartition(shares, "share")
        .sortWithinPartitions("share")
        .mapInPandas(_answer(least), "block long, cells binary, named binary")
    )
    found = (
        texts.groupBy("block").cogroup(back.groupBy("block")).applyInPandas(_find(longest, bits, shares, fingerprint_bits), _FOUND)
    )
    counted = durable(
        found.repartition(shares, "share").sortWithinPartitions("share").mapInPandas(_count(least), _COUNTED)
    )
    blank = counted.where("phrase IS NULL")
    needed = texts.join(blank.select("block").distinct(), "block", "left_semi")
    rest = needed.groupBy("block").cogroup(blank.groupBy("block")).applyInPandas(_last_look(longest, fingerprint_bits), _COUNTED)
    return durable(counted.where("phrase IS NOT NULL").unionByName(rest).select("lang", "n_words", "phrase", "f"))


def _words(start: Column, n: Column) -> Column:
    return F.array_join(F.slice("words", start, n), " ")


def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    inside_percent: int = 100,
    scale: int = 1000,
    **options,
) -> DataFrame:
    """The ``top`` phrases of each language by how far they exceed their parts.

    Texts are lowered in A-Z, cut into pieces at ``.,;:!?`` and \\n to \\r and those into words at
    spaces and tabs. With n word occurrences and f the occurrences inside pieces, a phrase of
    2 to ``longest`` words with a = f >= ``least`` scores floor(scale a n / (l r)) for a cut into
    parts of l and r occurrences; its lowest score counts, of equals the first cut's. A phrase goes
    if a longer one that holds its words has ``inside_percent`` of its occurrences.

    Returns (lang, rank, phrase, a, l, r, n, score), by score and a descending, then by phrase. NULL
    languages are ``und``; NULL and empty texts hold nothing; a repeated row counts again; an
    empty table gives an empty result; other columns are ignored. A text longer than a block is a
    block of its own.
    """
    known = frequent_phrases(docs, least, longest, **options)
    totals = known.where("n_words = 0").select("lang", F.col("f").alias("n"))
    candidates = known.where("n_words >= 2").select(
        "lang", "phrase", "n_words", F.col("f").alias("a"), F.split("phrase", " ").alias("words")
    )
    part = known.where("n_words >= 1").where(F.col("n_words") < longest).select("lang", "phrase", "f")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        _words(F.lit(1), F.col("k")).alias("left"),
        _words(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"),
    )
    cuts = enrich(cuts, part.toDF("lang", "left", "l"), ["lang", "left"], "inner")
    cuts = enrich(cuts, part.toDF("lang", "right", "r"), ["lang", "right"], "inner")
    cuts = enrich(cuts, totals, "lang", "inner")
    above = (F.col("a") * scale).cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")
    below = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    cuts = cuts.withColumn("above", above).withColumn("below", below)
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(lowest)

    sizes = F.explode(F.sequence(F.lit(2), F.col("n_words") - 1))
    offsets = F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1))
    inner = (
        candidates.where("n_words >= 3")
        .withColumn("size", sizes)
        .withColumn("at", offsets)
        .select("lang", _words(F.col("at"), F.col("size")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    whole = scored.join(inner.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    rows = whole.select("lang", "phrase", "a", "n", "cut.l", "cut.r", "cut.score")
    piece = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PIECES))
    for keys in ([F.col("lang"), piece], [F.col("lang")]):
        ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        rows = rows.withColumn("rank", ranked.cast("long")).where(F.col("rank") <= top)
    return rows.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
