"""Language of whole texts by unigram pieces, summed over all ways to cut words into pieces.

The pieces are a fixed public vocabulary of bytes. A language is a distribution over them, and
the probability of a word is the sum, over all its segmentations, of the product of
its pieces' probabilities: a forward pass over the word. A text's score is the sum of the logarithms
over its words and of that of the language's share. The distributions are fitted by expectation
maximisation: a forward and a backward pass give how often each piece is expected in the words
of a language, which Spark adds up; the state has a number per piece and language, whatever the
input.

Words are what stands between white space, A-Z lowered, with the space before them. A word of more
than ``UNIT`` bytes is taken as several units of that many; no byte is left out.
"""

from __future__ import annotations

import base64
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .shared import LOWER, UPPER, fold
from .words import hash_words

#: Rows learned from, for each language; the fit costs the same for any number of documents.
SAMPLE_ROWS = 2000
ROUNDS = 3
UNIT = 64
#: Longest piece, in bytes.
PIECE = 24
#: Weight of the pieces' distribution over all languages, in expected pieces.
SHARED = 2000.0
#: Added per byte in logarithms, so that 64 bytes of rare or frequent pieces stay within a double.
LIFT = 6.0
#: Words whose scores a task remembers.
REMEMBERED = 400_000
#: Texts, and then words, that are scored together.
GROUP_BYTES = 1 << 20
GROUP_WORDS = 1 << 14
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 20
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())


class Pieces:
    """A vocabulary of byte strings and the prefixes of its members, looked up by hash."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array([len(p) for p in pieces], np.int64)
        number: dict[bytes, int] = {}
        for k, piece in enumerate(pieces):
            for n in range(1, len(piece)):
                number.setdefault(piece[:n], -1)
            number[piece] = k
        hashes = np.zeros(len(number), np.uint64)
        for n in range(1, PIECE + 1):
            rows = [k for k, p in enumerate(number) if len(p) == n]
            if rows:
                table = np.frombuffer(b"".join([p for p in number if len(p) == n]), np.uint8).reshape(-1, n)
                h = np.zeros(len(rows), np.uint64)
                for column in table.T:
                    h = (h + column + np.uint64(1)) * _BASE
                hashes[rows] = h
        self.keys = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.ids = np.full(1 << _SLOT_BITS, -1, np.int32)
        left, slot, ids = hashes, self._slot(hashes), np.fromiter(number.values(), np.int32, len(number))
        self.probes = 0
        while len(left):
            # Of several keys for a free slot the last one gets it; the others go on to the next slot.
            free = self.keys[slot] == 0
            self.keys[slot[free]], self.ids[slot[free]] = left[free], ids[free]
            again = self.keys[slot] != left
            left, ids, slot = left[again], ids[again], (slot[again] + 1) % len(self.keys)
            self.probes += 1

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) * _BASE >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)

    def _find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash is a prefix, and the piece's number or -1."""
        known, ids = np.zeros(len(hashes), bool), np.full(len(hashes), -1, np.int32)
        at, slot = np.arange(len(hashes)), self._slot(hashes)
        for _ in range(self.probes):
            here = self.keys[slot]
            same = here == hashes[at]
            known[at[same]], ids[at[same]] = True, self.ids[slot[same]]
            go = ~same & (here != 0)
            at, slot = at[go], (slot[go] + 1) % len(self.keys)
            if not len(at):
                break
        return known, ids

    def matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and numbers of all pieces inside the units of ``data``; ``ends`` holds each byte's unit end."""
        at, h = np.arange(len(data)), np.zeros(len(data), np.uint64)
        starts, found = [], []
        for n in range(PIECE):
            inside = at + n < ends[at]
            at, h = at[inside], h[inside]
            if not len(at):
                break
            h = (h + data[at + n] + np.uint64(1)) * _BASE
            known, ids = self._find(h)
            hit = ids >= 0
            starts.append(at[hit])
            found.append(ids[hit])
            at, h = at[known], h[known]
        return (np.concatenate(starts), np.concatenate(found)) if starts else (np.empty(0, np.int64), np.empty(0, np.int32))


class Lattice:
    """All segmentations of many units at once: an arc for each piece at each place."""

    def __init__(self, units: list[bytes], pieces: Pieces):
        sizes = np.array([len(u) for u in units], np.int64)
        self.bytes = sizes
        data = np.frombuffer(b"".join(units), np.uint8)
        ends = np.cumsum(sizes)
        unit = np.repeat(np.arange(len(units)), sizes)
        start, self.piece = pieces.matches(data, ends[unit])
        self.unit = unit[start]
        # A unit of n bytes has n + 1 nodes.
        self.first = ends - sizes + np.arange(len(units))
        self.last = self.first + sizes
        self.tail = start + self.unit
        self.head = self.tail + pieces.sizes[self.piece]
        self.nodes = len(data) + len(units)

    def _levels(self, end: np.ndarray, offset: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Arcs in the order of ``offset``, a level at a time: arcs, nodes, first arc of each node."""
        order = np.lexsort((end, offset))
        cuts = np.flatnonzero(np.diff(offset[order], prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            arcs = order[a:b]
            starts = np.flatnonzero(np.diff(end[arcs], prepend=-1))
            yield arcs, end[arcs][starts], starts

    def forward(self, weights: np.ndarray) -> np.ndarray:
        """Sums over all ways from each unit's beginning to each node; weights per arc, or arc and language."""
        alpha = np.zeros((self.nodes, *weights.shape[1:]))
        alpha[self.first] = 1.0
        for arcs, nodes, starts in self._levels(self.head, self.head - self.first[self.unit]):
            alpha[nodes] = np.add.reduceat(alpha[self.tail[arcs]] * weights[arcs], starts, axis=0)
        return alpha

    def backward(self, weights: np.ndarray) -> np.ndarray:
        beta = np.zeros(self.nodes)
        beta[self.last] = 1.0
        for arcs, nodes, starts in self._levels(self.tail, self.last[self.unit] - self.tail):
            beta[nodes] = np.add.reduceat(beta[self.head[arcs]] * weights[arcs], starts)
        return beta

    def log_sums(self, weights: np.ndarray) -> np.ndarray:
        total = np.log(self.forward(weights)[self.last])
        return total - LIFT * (self.bytes if weights.ndim == 1 else self.bytes[:, None])


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a rank file that can stand in a word: a space at the beginning or none, and not too long."""
    with open(path, "rb") as lines:
        pieces = [base64.b64decode(line.split()[0]) for line in lines if line.strip()]
    white = b" \t\n\v\f\r"
    fit = [p for p in pieces if 0 < len(p) <= PIECE and not any(c in white for c in p[1:]) and p[:1] not in (b"\t", b"\n", b"\v", b"\f", b"\r")]
    missing = {bytes([c]) for c in range(256) if c not in white[1:]} - set(fit)
    return fit + sorted(missing)


def units_of(word: bytes) -> list[bytes]:
    spaced = b" " + word
    return [spaced[k : k + UNIT] for k in range(0, len(spaced), UNIT)]


@dataclass
class Model:
    """Languages, logarithms of their shares, and piece probabilities, lifted by their bytes."""

    langs: list[str]
    share: np.ndarray
    pieces: Pieces
    lifted: np.ndarray

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """log p of each word in each language."""
        scores = []
        for k in range(0, len(words), GROUP_WORDS):
            cut = [units_of(w) for w in words[k : k + GROUP_WORDS]]
            lattice = Lattice([u for units in cut for u in units], self.pieces)
            sums = lattice.log_sums(self.lifted[lattice.piece])
            scores.append(np.add.reduceat(sums, np.cumsum([0] + [len(u) for u in cut[:-1]]), axis=0))
        return np.concatenate(scores)


def _lifted(expected: np.ndarray, pieces: Pieces, shared: float) -> np.ndarray:
    """Piece probabilities of each language, drawn towards those of all, times the lift of their bytes."""
    pooled = expected.sum(axis=1) + 0.5
    pooled /= pooled.sum()
    p = (expected + shared * pooled[:, None]) / (expected.sum(axis=0) + shared)
    return p * np.exp(LIFT * pieces.sizes)[:, None]


def _unit_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: Counter = Counter()
        for text, lang in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("lang").to_pylist()):
            for word, n in Counter(text.translate(_LOWERED).split()).items():
                for unit in units_of(word):
                    found[lang, unit] += n
        langs, units = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(units, pa.binary()), pa.array(found.values(), pa.int64())],
            ["lang", "unit", "n"],
        )


def _expect(langs: list[str], pieces: Pieces, lifted: np.ndarray | None):
    number = {name: k for k, name in enumerate(langs)}

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(pieces.sizes), len(langs)))
        for batch in batches:
            if len(batch) == 0:
                continue
            lattice = Lattice([bytes(u) for u in batch["unit"]], pieces)
            lang = batch["lang"].map(number).to_numpy()[lattice.unit]
            weights = lifted[lattice.piece, lang] if lifted is not None else np.full(len(lattice.piece), 1.0)
            alpha, beta = lattice.forward(weights), lattice.backward(weights)
            often = batch["n"].to_numpy() / alpha[lattice.last]
            share = alpha[lattice.tail] * weights * beta[lattice.head] * often[lattice.unit]
            np.add.at(total, (lattice.piece, lang), share)
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"piece": piece, "lang": lang, "expected": total[piece, lang]})

    return expect


def fit(rows: DataFrame, pieces: Pieces, sample_rows: int = SAMPLE_ROWS, rounds: int = ROUNDS, shared: float = SHARED) -> Model:
    """Fit piece probabilities to (text, lang), at most ``sample_rows`` rows of a language.

    The first round gives every segmentation of a word the same weight. Rows are drawn by a
    hash of all their columns, so reruns learn from the same ones.
    """
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.empty(0), pieces, np.empty((len(pieces.sizes), 0)))
    drawn = F.xxhash64(*rows.columns)
    # Far more rows than needed are dropped where they stand, the others are ranked.
    wanted = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(max(1, counts[name] // (2 * sample_rows))))])
    near = rows.where(F.pmod(drawn, wanted[F.col("lang")]) == 0)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(drawn))
    sample = near.withColumn("rank", rank).where(F.col("rank") <= sample_rows).select("text", "lang")
    units = durable(
        sample.mapInArrow(_unit_counts, "lang string, unit binary, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n"))
    )
    lifted = None
    for _ in range(rounds):
        sums = units.mapInPandas(_expect(langs, pieces, lifted), "piece int, lang int, expected double")
        found = sums.groupBy("piece", "lang").agg(F.sum("expected").alias("expected")).toPandas()
        expected = np.zeros((len(pieces.sizes), len(langs)))
        expected[found["piece"], found["lang"]] = found["expected"]
        lifted = _lifted(expected, pieces, shared)
    share = np.array([counts[name] for name in langs], np.float64)
    return Model(langs, np.log(share / share.sum()), pieces, lifted)


class Memory:
    """Scores of words by their hash, for as many as ``REMEMBERED``."""

    def __init__(self, model: Model):
        self.model = model
        self.keys, self.scores = np.empty(0, np.uint64), np.empty((0, len(model.langs)))

    def texts(self, texts: list[bytes]) -> np.ndarray:
        """Sums of log p over the words of each text, in each language."""
        data = b"\n".join(texts).translate(_LOWERED)
        starts, ends, hashes = hash_words(data)
        keys, first, group = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = self.keys[at] != keys if len(self.keys) else np.ones(len(keys), bool)
        if new.any():
            words = [data[starts[k] : ends[k]] for k in first[new].tolist()]
            kept = self.keys, self.scores
            if len(self.keys) > REMEMBERED:
                # What this group needs is worked out again; nothing else depends on it.
                kept = np.empty(0, np.uint64), self.scores[:0]
                words = [data[starts[k] : ends[k]] for k in first.tolist()]
                new = np.ones(len(keys), bool)
            joined = np.concatenate((kept[0], keys[new]))
            order = np.argsort(joined)
            self.keys = joined[order]
            self.scores = np.concatenate((kept[1], self.model.word_scores(words)))[order]
        per_word = self.scores[np.searchsorted(self.keys, keys)]
        cuts = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts]))
        text = np.repeat(np.arange(len(texts)), np.diff(cuts))
        return np.stack(
            [np.bincount(text, weights=per_word[group, k], minlength=len(texts)) for k in range(per_word.shape[1])], axis=1
        )


def _predict(model: Model):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = Memory(model)
        names = np.array(model.langs, object)
        for batch in batches:
            texts = batch.column("text")
            sums = np.zeros((len(texts), len(names)))
            begin, held = 0, 0
            for k, size in enumerate(pc.binary_length(texts).to_pylist()):
                held += size
                if held >= GROUP_BYTES or k + 1 == len(texts):
                    sums[begin : k + 1] = memory.texts(texts.slice(begin, k + 1 - begin).cast(pa.binary()).to_pylist())
                    begin, held = k + 1, 0
            logits = sums + model.share
            best = logits.argmax(axis=1) if len(texts) else np.empty(0, np.int64)
            top = logits[np.arange(len(texts)), best]
            score = 1.0 / np.exp(logits - top[:, None]).sum(axis=1)
            spoken = batch.column("spoken").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(np.where(spoken, names[best], "und"), pa.string()),
                    pa.array(np.where(spoken, score, 0.0), pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    return predict


def predict_language(
    docs: DataFrame,
    vocabulary: str,
    folds: int = 5,
    held_fold: int = 0,
    sample_rows: int = SAMPLE_ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """The language of every whole text: (doc_id, held_out, lang_pred, score).

    Learns from the text and non-NULL language of rows outside the held-out fold (crc32 of the id as
    text, modulo ``folds``, is ``held_fold``), at most ``sample_rows`` of each language. ``vocabulary`` is a
    rank file. ``score`` is the share of the predicted language in the sum over all languages. A NULL
    text, or one without a letter, is ``und`` with score 0, and so is every text if no language is
    known; of equal languages the first by name is predicted. A NULL id is not held out. Repeated
    rows are predicted each; other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.col(lang_col).cast("string").alias("lang"),
    ).withColumn("held_out", fold("doc_id", folds) == held_fold)
    spoken = F.col("text").rlike(r"\p{L}")
    pieces = Pieces(read_pieces(vocabulary))
    model = fit(rows.where(~F.col("held_out") & F.col("lang").isNotNull() & spoken).select("text", "lang"), pieces, sample_rows)
    kind = dict(rows.dtypes)["doc_id"]
    result = f"doc_id {kind}, held_out boolean, lang_pred string, score double"
    if not model.langs:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.select("doc_id", "held_out", "text", spoken.alias("spoken")).mapInArrow(_predict(model), result)
