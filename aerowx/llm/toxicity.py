"""Toxicity scores from a linear classifier, regularised by counterfactual sentences.

Features are the distinct words of the whole text and the beginnings of longer words, hashed.
Counts of every feature among a bounded, repeatable sample of labelled training rows choose
the telling ones; the weights are then fitted on that sample. Beside the usual loss, each
text whose sentences name a group of people is paired with the same text in which these
terms are swapped for other groups, and a difference between the two scores is penalised:

    loss = cross entropy + ridge |w|^2 + counterfactual * mean (f(x) - f(x'))^2

So a mention of a group alone moves the score as little as the data allow.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .shared import fold, id_text

#: At most so many labelled rows are learned from: those of the smallest hash of their id.
SAMPLE_ROWS = 30_000
#: Sizes of the hashed feature space and of the part that gets a weight.
CELLS = 1 << 20
_SHARE = 1 << 15
MAX_FEATURES = 50_000
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3

#: Terms for groups of people, those of one line interchangeable (default word list).
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("gay", "lesbian", "bisexual", "straight", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "african", "european", "hispanic"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens", "migrants"),
    ("disabled", "blind", "deaf", "elderly", "young", "old"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"),
    ("ausländer", "flüchtlinge", "einwanderer", "einheimische"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"),
    ("immigrés", "réfugiés", "étrangers", "citoyens"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "budistas", "ateos"),
    ("inmigrantes", "refugiados", "extranjeros", "ciudadanos"),
)

_WORD = re.compile(r"[^\W\d_]+")


def _swaps(terms) -> dict[str, str]:
    """Each term's counterpart: the next of its line."""
    return {t: line[(k + 1) % len(line)] for line in terms for k, t in enumerate(line)}


def word_features(word: str) -> tuple[int, ...]:
    names = [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]
    return tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) % CELLS for x in names)


class _Words:
    """Features of words, remembered up to a bound."""

    def __init__(self, chosen: np.ndarray | None = None, bound: int = 500_000):
        self.place = None if chosen is None else {int(f): k for k, f in enumerate(chosen)}
        self.bound, self.known = bound, {}

    def __call__(self, word: str) -> tuple[int, ...]:
        found = self.known.get(word)
        if found is None:
            found = word_features(word)
            if self.place is not None:
                found = tuple(self.place[f] for f in found if f in self.place)
            if len(self.known) >= self.bound:
                self.known.clear()
            self.known[word] = found
        return found

    def of(self, words: set[str]) -> set[int]:
        out: set[int] = set()
        for word in words:
            found = self(word)
            if found:
                out.update(found)
        return out


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def _feature_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros((2, CELLS), np.uint32)
    features = _Words()
    rows = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch["text"], batch["toxic"]):
            found = features.of(words_of(text))
            counts[toxic, list(found)] += 1
            rows[toxic] += 1
    shares = [k for k in range(CELLS // _SHARE) if counts[:, k * _SHARE : (k + 1) * _SHARE].any()]
    parts = [np.ascontiguousarray(counts[:, k * _SHARE : (k + 1) * _SHARE]).tobytes() for k in shares]
    if sum(rows):
        shares, parts = [*shares, -1], [*parts, np.array(rows, np.uint32).tobytes()]
    yield pd.DataFrame({"share": pd.Series(shares, dtype="int64"), "counts": pd.Series(parts, dtype=object)})


def _add_shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for share, blob in zip(batch["share"], batch["counts"]):
            part = np.frombuffer(blob, np.uint32)
            sums[share] = sums[share] + part if share in sums else part
    yield pd.DataFrame(
        {"share": pd.Series(list(sums), dtype="int64"), "counts": pd.Series([x.tobytes() for x in sums.values()], dtype=object)}
    )


def telling_features(counts: np.ndarray, rows: np.ndarray, most: int, least_rows: int = 4) -> np.ndarray:
    """Features by their log-likelihood ratio with the label, where it isn't chance."""
    neg, pos = counts.astype(np.float64)
    n_neg, n_pos = float(rows[0]), float(rows[1])
    if n_pos == 0 or n_neg == 0:
        return np.empty(0, np.int64)
    both, total = neg + pos, n_neg + n_pos

    def term(seen, expected):
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-300) / np.maximum(expected, 1e-300)), 0.0)

    gain = term(pos, both * n_pos / total) + term(neg, both * n_neg / total)
    gain += term(n_pos - pos, (total - both) * n_pos / total) + term(n_neg - neg, (total - both) * n_neg / total)
    fit = np.flatnonzero((both >= least_rows) & (2 * gain >= 12))
    order = np.lexsort((fit, -gain[fit]))
    return np.sort(fit[order[:most]])


def _chosen_features(chosen, swaps):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features = _Words(chosen.value)
        for batch in batches:
            own, other = [], []
            for text in batch["text"]:
                words = words_of(text)
                own.append(sorted(features.of(words)))
                named = words & swaps.keys()
                swapped = (words - named) | {swaps[w] for w in named}
                other.append(sorted(features.of(swapped)) if named else None)
            yield batch[["doc_id", "toxic"]].assign(own=own, other=other)

    return rows


def feature_key(features) -> bytes:
    """Bytes that sort as the numbers do one by one; tuples of them take ten times the driver's memory."""
    return np.asarray(features, ">u4").tobytes()


def _sparse(lists) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(x) for x in lists]
    row = np.repeat(np.arange(len(lists)), sizes)
    return row, np.concatenate([np.asarray(x, np.int64) for x in lists]) if sum(sizes) else np.empty(0, np.int64)


def fit(own, other, toxic, n_features: int, ridge: float, counterfactual: float, steps: int = 400) -> np.ndarray:
    """Weights of the features and, last, the intercept, by accelerated gradient descent."""
    y = np.asarray(toxic, np.float64)
    n = len(y)
    row, col = _sparse(own)
    pairs = [k for k, x in enumerate(other) if x is not None]
    pair_row, pair_col = _sparse([other[k] for k in pairs])
    pairs = np.array(pairs, np.int64)
    weights = np.zeros(n_features + 1)
    weights[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    first, second = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        value = np.bincount(row, weights=weights[col], minlength=n) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(value, -40, 40))) - y) / n
        gradient = np.append(np.bincount(col, weights=error[row], minlength=n_features), error.sum())
        gradient[:-1] += ridge / n * weights[:-1]
        if len(pairs):
            swapped = np.bincount(pair_row, weights=weights[pair_col], minlength=len(pairs)) + weights[-1]
            gap = 2 * counterfactual * (value[pairs] - swapped) / len(pairs)
            spread = np.zeros(n)
            spread[pairs] = gap
            gradient[:-1] += np.bincount(col, weights=spread[row], minlength=n_features)
            gradient[:-1] -= np.bincount(pair_col, weights=gap[pair_row], minlength=n_features)
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = 0.1 * (1 - step / steps) + 0.002
        weights -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return weights


def train(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    sample_rows: int = SAMPLE_ROWS,
    identity_terms=IDENTITY_TERMS,
    ridge: float = 0.3,
    counterfactual: float = 1.0,
) -> tuple[np.ndarray, np.ndarray]:
    """(features, weights) learned from (doc_id, toxic) rows outside the held-out fold.

    ``sample_rows`` bounds the rows learned from, and so what meets in the driver: the
    chosen features of those rows. Rows without a label or id are ignored; of several labels
    for one id the largest counts. Without rows of both labels there are no features, and the
    intercept alone scores.
    """
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.where("doc_id IS NOT NULL AND toxic IN (0, 1)").where(fold("doc_id", folds) != held_fold)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = durable(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learned = texts.join(F.broadcast(sample), "doc_id")
    counted = learned.mapInPandas(_feature_counts, "share long, counts binary")
    summed = counted.repartition(16, "share").mapInPandas(_add_shares, "share long, counts binary").collect()
    counts, rows = np.zeros((2, CELLS), np.uint32), np.zeros(2, np.uint32)
    for share, blob in summed:
        if share < 0:
            rows = np.frombuffer(blob, np.uint32)
        else:
            counts[:, share * _SHARE : (share + 1) * _SHARE] = np.frombuffer(blob, np.uint32).reshape(2, -1)
    features = telling_features(counts, rows, MAX_FEATURES)
    swaps = _swaps(identity_terms)
    chosen = spark.sparkContext.broadcast(features)
    found = learned.mapInPandas(
        _chosen_features(chosen, swaps), "doc_id long, toxic int, own array<int>, other array<int>"
    ).toPandas()
    found["own_key"] = [feature_key(x) for x in found["own"]]
    found = found.sort_values(["doc_id", "own_key"], ignore_index=True).drop(columns="own_key")
    if not len(found):
        return features, np.zeros(1)
    weights = fit(found["own"].tolist(), found["other"].tolist(), found["toxic"], len(features), ridge, counterfactual)
    return features, weights


def _scores(model):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        features, weights = model.value
        words = _Words(features)
        for batch in batches:
            out = []
            for text in batch["text"]:
                found = words.of(words_of(text))
                out.append(weights[sorted(found)].sum() + weights[-1])
            value = np.clip(np.array(out, np.float64), -40, 40)
            yield batch[["doc_id"]].assign(score=1 / (1 + np.exp(-value)))

    return score


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    folds: int = 4,
    held_fold: int = 2,
    threshold: float = THRESHOLD,
    **options,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row: the whole text's toxicity in 0..1.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic (0 or 1); other columns are
    never read. A row is held out of training if crc32 of its id as text, modulo ``folds``,
    is ``held_fold``. NULL and empty texts have no features and get the intercept's score;
    rows with a NULL id are scored and not held out. Repeated rows each get their score. An
    empty table gives an empty result; without labels every score is 0.5.
    """
    features, weights = train(docs, labels, folds, held_fold, **options)
    model = docs.sparkSession.sparkContext.broadcast((features, weights))
    rows = docs.select(id_text("doc_id").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInPandas(_scores(model), "doc_id string, score double")
    scored = scored.withColumn("doc_id", F.col("doc_id").cast("long"))
    return scored.select(
        "doc_id",
        (fold("doc_id", folds) == held_fold).alias("held_out"),
        "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).cast("int").alias("predicted"),
    )
