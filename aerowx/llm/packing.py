"""Packing token sequences by minimum bin slack.

Texts become ids once. A document longer than a window is cut into whole windows and a rest;
whole windows need no packing. What is packed is the *number* of rests of each length, at
most one count per length below the capacity, so the table that plans the packing has a
fixed size whatever the input. The largest length left opens a window; a bitset of the sums
that the other lengths can reach, each as often as it is left, gives the fill closest to
capacity, and walking back through the bitsets gives how often each length is used. The
pattern is repeated as long as its counts last. Pieces then find their place by their rank
among pieces of their length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import id_text, written

CAPACITY = 2048
END_ID = 1
_RANK_BUCKETS = 512
_REMEMBERED = 250_000

#: How the vocabulary's tokenizer splits text before merging (fixed value).
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a printable letter: others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Ids of whole texts, equal to those the tokenizer file gives without added tokens.

    A space followed by a run of other characters is encoded apart from its neighbours, so
    such pieces are remembered, up to a bound; where white space meets white space the
    texts around it are encoded together.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(letters[c] for c in t): k for t, k in spec["model"]["vocab"].items() if t not in special}
        self.special = tuple(special)
        self.coder = tiktoken.Encoding(path, pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.known: dict[str, bytes] = {}

    def _raw(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            ids = self.coder.encode(text, allowed_special="all")
        else:
            ids = self.coder.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def _remembered(self, chunk: str) -> bytes:
        found = self.known.get(chunk)
        if found is None:
            if len(self.known) >= _REMEMBERED:
                self.known.clear()
            found = self.known[chunk] = self._raw(chunk)
        return found

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if not text:
            return b""
        chunks = text.split(" ")
        out, known = [], self.known
        held = chunks[0]
        fresh = True
        for chunk in chunks[1:]:
            if chunk and held and not held[-1].isspace() and not chunk[0].isspace():
                out.append(known.get(held) or self._remembered(held))
                held = " " + chunk
                fresh = False
            else:
                held = f"{held} {chunk}"
        out.append(self._raw(held) if fresh else self._remembered(held))
        return b"".join(out)


_encoders: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int):
    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encoder = _encoders[path]
        end = np.array([END_ID], "<u4").tobytes()
        step = 4 * capacity
        for batch in batches:
            rows = []
            for doc, text in zip(batch["doc_id"], batch["text"]):
                ids = encoder.ids(text) + end
                total = len(ids) // 4
                for at in range(0, len(ids), step):
                    part = ids[at : at + step]
                    rows.append((doc, at // 4, len(part) // 4, zlib.crc32(part), total))
            yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return pieces


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, each at most as often as counted, that fills ``room`` best."""
    if room <= 0:
        return {}
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if counts[x] and x <= room), reverse=True):
        before, left, size = reach, min(counts[length], room // length), 1
        while left:
            size = min(size, left)
            reach |= (reach << (size * length)) & mask
            left -= size
            size *= 2
        steps.append((length, before))
        if reach >> room & 1:
            break
    fill = reach.bit_length() - 1
    used: dict[int, int] = {}
    for length, before in reversed(steps):
        while not before >> fill & 1:
            fill -= length
            used[length] = used.get(length, 0) + 1
    return used


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how many windows, lengths in each) until all pieces are placed.

    The largest length left opens the window, so each pattern uses up a length, and there
    are at most a few patterns for each length below the capacity.
    """
    left = {k: n for k, n in counts.items() if n}
    out = []
    while left:
        largest = max(left)
        rest = dict(left)
        rest[largest] -= 1
        used = closest_fill(rest, capacity - largest)
        used[largest] = used.get(largest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        out.append((times, used))
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def _slots(patterns: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """For each length, rows of: first rank, first window, pieces per window, first offset."""
    slots: dict[int, list] = {}
    taken: dict[int, int] = {}
    window = 0
    for times, used in patterns:
        offset = 0
        for length in sorted(used, reverse=True):
            n = used[length]
            slots.setdefault(length, []).append((taken.get(length, 0), window, n, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        window += times
    return {k: np.array(v, np.int64) for k, v in slots.items()}


def _place(slots):
    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = slots.value
        for batch in batches:
            rank, length = batch["rank"].to_numpy(), batch["length"].to_numpy()
            window, offset = np.empty(len(batch), np.int64), np.empty(len(batch), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                first, base, per, start = table[int(size)].T
                k = np.searchsorted(first, rank[at], side="right") - 1
                inside = rank[at] - first[k]
                window[at] = base[k] + inside // per[k]
                offset[at] = start[k] + inside % per[k] * size
            yield batch.drop(columns=["rank"]).assign(sequence_id=window, offset=offset)

    return place


def ranked(df: DataFrame, group: str, order: list[str], name: str = "rank") -> DataFrame:
    """Number the rows of each group from 0, without bringing a group into one task.

    Rows of a group are dealt over buckets by a hash of ``order`` and numbered there; rows
    before a bucket come from one count per group and bucket. Rows alike in ``order`` are
    interchangeable.
    """
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(_RANK_BUCKETS)).cast("int"))
    counts = dealt.groupBy(group, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    numbered = dealt.withColumn("_place", F.row_number().over(inside) - 1)
    joined = numbered.join(offsets.hint("merge"), [group, "_bucket"])
    return joined.withColumn(name, (F.col("_before") + F.col("_place")).cast("long")).drop("_before", "_place", "_bucket")


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pack the ids of all texts into sequences of at most ``capacity``.

    A document is its text's ids and then id 1. Returns per piece: doc_id, start, length,
    ids_crc32 (of its ids as little-endian unsigned 32-bit numbers), doc_tokens, sequence_id,
    offset. Pieces of a sequence follow each other from offset 0 without gaps. ``tokenizer``
    is the path of a byte-level BPE tokenizer file that every executor can read.

    NULL and empty texts are one id long. Rows that repeat, or share an id, are documents of
    their own. NULL ids stay NULL. Other columns are ignored; an empty table gives an empty
    result.
    """
    rows = docs.select(
        id_text(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    pieces = written(
        rows.mapInPandas(
            _pieces(tokenizer, capacity), "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
        ).withColumn("doc_id", F.col("doc_id").cast("long")),
        "pieces",
    )
    # One row per length, so at most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = docs.sparkSession.sparkContext.broadcast(_slots(plan(counts, capacity)))
    columns = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long"
    numbered = ranked(pieces, "length", ["doc_id", "start", "ids_crc32", "doc_tokens"])
    placed = numbered.select(id_text("doc_id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "rank").mapInPandas(
        _place(slots), f"{columns}, sequence_id long, offset long"
    )
    return placed.withColumn("doc_id", F.col("doc_id").cast("long"))
