"""N-gram scoring of texts by a weighted backoff automaton, built and walked in blocks.

States are n-grams; the arc for a word carries its smoothed probability, and where a state
has no arc for a word, a failure arc with a weight of its own leads to the state that
forgets the oldest word. With c the training counts and h' the shorter history,

    p(w)    = (c(w) + 0.5) / (N + 0.5 (V + 1))
    p(w|h)  = (c(hw) + m p(w|h')) / (c(h) + m)

so an arc is p(w|h), and the failure arc of h weighs m / (c(h) + m). Each order sums to one.

The automaton grows with the corpus and is never gathered. Texts are dealt into blocks of
bounded size; each block sends the n-grams it holds, with its own counts, to the shuffle,
gets back what other blocks have counted of them, and builds the states and arcs its
texts can reach. It then walks every text from left to right once, carrying a state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Automaton
from .runs import run_starts, slices, whole_runs
from .shared import fold, id_text
from .words import grams, mixed, text_words

ORDER = 2
#: Weight of the shorter history, in counts.
BACKOFF = 50.0
BLOCK_BYTES = 8 << 20
END = mixed(np.array([1], np.uint64), 21)[0]
START = mixed(np.array([2], np.uint64), 22)[0]


def _keys(tokens: np.ndarray, order: int) -> np.ndarray:
    """Keys of all n-grams of a flat row of tokens; the low two bits hold the order."""
    return (grams(tokens, order, 40) & ~np.uint64(3)) | np.uint64(order)


def _sequence(texts, train) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of texts in a row, each as start, words, end; text numbers, places, in training."""
    parts, sizes = [], []
    for words in text_words(texts):
        parts += [np.array([START]), words, np.array([END])]
        sizes.append(len(words) + 2)
    sizes = np.array(sizes, np.int64)
    tokens = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    text = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return tokens, text, place, np.asarray(train, bool)[text] if len(sizes) else np.empty(0, bool)


def _block_keys(tokens, place, train, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a block, sorted, and their counts in its training texts."""
    keys, weights = [], []
    for n in range(1, order + 1):
        inside = place[n - 1 :] >= n - 1
        keys.append(_keys(tokens, n)[inside])
        weights.append(train[n - 1 :][inside])
    keys, weights = np.concatenate(keys), np.concatenate(weights)
    by_key = np.argsort(keys, kind="stable")
    keys, weights = keys[by_key], weights[by_key]
    starts = run_starts(keys)
    return keys[starts], np.add.reduceat(weights.astype(np.int64), starts) if len(starts) else np.empty(0, np.int64)


def _vocabulary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distinct training tokens of a batch; with key NULL, how many tokens it has."""
    for batch in batches:
        tokens, _, _, train = _sequence(batch["text"], batch["train"])
        words = tokens[train & (tokens != START)]
        stats = pd.DataFrame({"key": pd.array([None], "Int64"), "tokens": [len(words)]})
        found = pd.DataFrame({"key": pd.array(np.unique(words).view(np.int64), "Int64"), "tokens": 0})
        yield pd.concat([stats, found], ignore_index=True)


def _planes(values: np.ndarray) -> bytes:
    """Numbers with their first bytes together, then their second and so on.

    Gaps of sorted keys and counts have empty high bytes, which the shuffle's compression
    then finds in long runs.
    """
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def _numbers(planes: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(planes, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def _by_share(keys: np.ndarray, shares: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of sorted keys in the order of their shares; each share's number and start."""
    share = ((keys >> np.uint64(8)) % np.uint64(shares)).astype(np.int64)
    places = np.argsort(share, kind="stable")
    starts = run_starts(share[places])
    return places, share[places][starts], np.append(starts, len(keys))


def _send(order: int, shares: int):
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["block"]):
            for a, b in slices(frame, ["block"]):
                part = frame.iloc[a:b]
                tokens, _, place, train = _sequence(part["text"], part["train"])
                keys, counts = _block_keys(tokens, place, train, order)
                places, share, cuts = _by_share(keys, shares)
                keys, counts = keys[places], counts[places].astype(np.uint32)
                ends = list(zip(cuts[:-1], cuts[1:]))
                yield pd.DataFrame(
                    {
                        "share": share,
                        "block": part["block"].iloc[0],
                        "keys": [_planes(np.diff(keys[x:y], prepend=np.uint64(0))) for x, y in ends],
                        "counts": [_planes(counts[x:y]) for x, y in ends],
                    }
                )

    return send


def _total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """To each block, what others have counted of the keys it sent, in the order it sent them."""
    for frame in whole_runs(batches, ["share"]):
        for a, b in slices(frame, ["share"]):
            part = frame.iloc[a:b]
            keys = [np.cumsum(_numbers(x, np.uint64), dtype=np.uint64) for x in part["keys"]]
            counts = [_numbers(x, np.uint32) for x in part["counts"]]
            cuts = np.cumsum([0] + [len(k) for k in keys])
            flat, own = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
            by_key = np.argsort(flat, kind="stable")
            starts = run_starts(flat[by_key])
            sums = np.add.reduceat(own[by_key], starts)
            others = np.empty(len(flat), np.int64)
            others[by_key] = np.repeat(sums, np.diff(np.append(starts, len(flat))))
            others -= own
            rows = [
                (block, share, _planes(others[x:y]))
                for block, share, x, y in zip(part["block"], part["share"], cuts[:-1], cuts[1:])
                if others[x:y].any()
            ]
            yield pd.DataFrame(rows, columns=["block", "share", "others"])


def _score(order: int, shares: int, backoff: float, total_tokens: int, distinct: int):
    def score(key, docs: pd.DataFrame, back: pd.DataFrame) -> pd.DataFrame:
        if len(docs) == 0:
            return pd.DataFrame({c: [] for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score", "score")})
        tokens, text, place, train = _sequence(docs["text"], docs["train"])
        keys, counts = _block_keys(tokens, place, train, order)
        places, share, cuts = _by_share(keys, shares)
        at = {int(k): places[x:y] for k, x, y in zip(share, cuts[:-1], cuts[1:])}
        for k, others in zip(back["share"], back["others"]):
            counts[at[k]] += _numbers(others, np.int64)

        def count(n: int, ends: np.ndarray) -> np.ndarray:
            wanted = _keys(tokens, n)[ends - (n - 1)]
            return counts[np.searchsorted(keys, wanted)].astype(np.float64)

        automaton = Automaton(tokens, place, count, order, total_tokens, distinct, backoff)
        logs, seen = automaton.traverse(place), automaton.seen
        base = np.log10((seen + 0.5) / (total_tokens + 0.5 * (distinct + 1)))
        real = place > 0
        n = len(docs)
        return pd.DataFrame(
            {
                "doc_id": docs["doc_id"].to_numpy(),
                "held_out": docs["held_out"].to_numpy(),
                "n_tokens": np.bincount(text[real], minlength=n),
                "n_known": np.bincount(text[real], weights=seen[real] > 0, minlength=n).astype(np.int64),
                "base_score": np.bincount(text[real], weights=base[real], minlength=n),
                "score": np.bincount(text[real], weights=logs[real], minlength=n),
            }
        )

    return score


def lm_score(
    docs: DataFrame,
    folds: int = 5,
    held_fold: int = 1,
    order: int = ORDER,
    backoff: float = BACKOFF,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Score whole texts by an n-gram model of those outside the held-out fold.

    A row is held out if crc32 of its id as text, modulo ``folds``, is ``held_fold``. Returns
    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) per input row, in
    log10. Tokens are the words (runs of characters other than space and \\t to \\r, A-Z
    lowered) and one end, so an empty or NULL text has one token. Rows with a NULL id train
    and are not held out. Repeated rows count as often as they stand. Other columns are
    ignored; an empty table gives an empty result. ``order`` is 1 to 3.
    """
    if not 1 <= order <= 3:
        raise ValueError("order must be 1, 2 or 3")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("held_out", fold("doc_id", folds) == held_fold).withColumn("train", ~F.col("held_out"))
    words = rows.select("text", "train").mapInPandas(_vocabulary, "key long, tokens long")
    summed = words.groupBy("key").agg(F.sum("tokens").alias("tokens"))
    known, total = summed.agg(F.count("key"), F.sum("tokens")).first()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    dealt = rows.withColumn("block", place).withColumn("doc_id", id_text("doc_id")).repartition(blocks, "block")
    sent = dealt.sortWithinPartitions("block").mapInPandas(
        _send(order, blocks), "share long, block int, keys binary, counts binary"
    )
    back = (
        sent.repartition(blocks, "share")
        .sortWithinPartitions("share")
        .mapInPandas(_total, "block int, share long, others binary")
    )
    scored = (
        dealt.groupBy("block")
        .cogroup(back.groupBy("block"))
        .applyInPandas(
            _score(order, blocks, backoff, total or 0, known or 0),
            "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known", F.lit(total or 0).cast("long").alias("train_tokens"), "base_score", "score"
    )
