"""Jaccard self-join of shingle sets, filtered under several global token orders.

Two sets of Jaccard t or more share, under *any* order of all tokens, a token among their
first n - ceil(t n) + 1. Several orders give several such conditions, and a pair must meet
all of them before its sets are compared:

1. One pass finds each document's set, its digest, and a sketch of token frequencies, whose
   cells grow with the text up to a bound. All orders put tokens of frequent sketch cells last; within a level each
   order has a hash of its own.
2. A second pass emits the prefix tokens under the first order. Documents that share one are
   paired if they are few; if they are many, each is tied to the first of them. A third
   does the same under the other orders for documents that have a partner so far; they are
   known by a bitmap of fixed size, which may let others through but loses none. Prefix
   tokens travel as packed columns, one row for each bucket of tokens, and many documents
   of one task that share a token as ties and one entry.
3. A pair counts only where the first token that it may share leaves room in both sets for
   an intersection of the wanted size. Pairs are intersected over the orders. Pairs make
   candidate groups, and so do ties.
4. Groups are compared in tiles: each text goes to the tiles of its group, intersections
   are a matrix product, and what links within a tile is handed on as a tree.

No pair within a large group is ever a row, and no link is lost: a linked pair either
shares a few-document token under every order, or a many-document token under some.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .bitmap import bitmap, has_bits
from .components import components
from .runs import packed, run_starts, slices, unpacked, whole_runs
from .shared import id_text, written
from .words import mixed, shingle_set, text_words

ORDERS = 3
#: Cells of the sketch at least and at most, and bytes of text for a cell, some 24 tokens.
CELLS = 1 << 22
MOST_CELLS = 1 << 25
_TEXT_OF_CELL = 192
_SHARE = 1 << 15
#: Bits that tell which documents have a partner.
FILTER_BITS = 1 << 24
#: Documents that share a token are paired up to this number, and tied beyond it.
FEW = 32
#: A bucket holds about so many prefix tokens, and there are so many buckets at least.
BUCKET = 1 << 18
LEAST_BUCKETS = 64
#: Buckets that meet in a task, on average, at most.
TASK_BUCKETS = 4
#: What names a tie beside a bit for each order.
TIE = 1 << ORDERS
#: Bits of a prefix token that travel, without its order: tokens alike in these only add candidates.
_TOKEN_BITS = 48
#: A prefix token's packed columns: the token less the one before, node, size of the set, place in it, whether tied.
_PACKED = (np.uint64, np.int64, np.uint32, np.uint32, np.uint8)
#: A tile holds about so many documents and shingles of each of its two sides.
TILE_DOCS = 512
TILE_SHINGLES = 1 << 21
_FLUSH = 1 << 20
_COLUMNS = 4096
#: Tokens of at most this part of a tile's sets are counted pair by pair.
_SPARSE = 12


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _node(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def sketch_cells(text_bytes: int) -> int:
    """Cells for so much text, a power of two: in too few, rare tokens pass for frequent ones."""
    wanted = 1 << max(0, text_bytes // _TEXT_OF_CELL - 1).bit_length()
    return min(MOST_CELLS, max(CELLS, wanted))


def _cells(tokens: np.ndarray, cells: int) -> np.ndarray:
    return (mixed(tokens, 7) & np.uint64(cells - 1)).astype(np.int64)


def _scan(size: int, cells: int):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts = np.zeros(cells, np.uint32)
        for batch in batches:
            n, digests = [], []
            for words in text_words(batch["text"]):
                tokens = shingle_set(words, size)
                n.append(len(tokens))
                digests.append(_digest(tokens) if len(tokens) else None)
                np.add.at(counts, _cells(tokens, cells), 1)
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"], "n": n, "digest": digests, "share": None, "counts": None}
            )
        shares = [k for k in range(cells // _SHARE) if counts[k * _SHARE : (k + 1) * _SHARE].any()]
        blobs = [_counts_blob(counts[k * _SHARE : (k + 1) * _SHARE]) for k in shares]
        none = [None] * len(shares)
        yield pd.DataFrame(
            {"doc_id": pd.Series(none, dtype=object), "n": pd.array(none, "Int64"), "digest": none, "share": shares, "counts": blobs}
        )

    return scan


def _counts_blob(counts: np.ndarray) -> bytes:
    """A share's counts in as few bytes each as hold the largest; the length tells how many."""
    return zlib.compress(counts.astype(np.min_scalar_type(counts.max())).tobytes(), 1)


def _blob_counts(blob: bytes) -> np.ndarray:
    data = zlib.decompress(blob)
    return np.frombuffer(data, f"u{len(data) // _SHARE}").astype(np.int64)


def _sum_shares(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for share, blob in zip(batch["share"], batch["counts"]):
            part = _blob_counts(blob)
            sums[share] = sums[share] + part if share in sums else part
    levels = [(4 * np.log2(np.maximum(x, 1))).astype(np.uint8).tobytes() for x in sums.values()]
    yield pd.DataFrame({"share": list(sums), "levels": levels})


def _levels(shares: DataFrame, cells: int) -> np.ndarray:
    """The frequency level of every sketch cell: a byte each, MOST_CELLS at most."""
    summed = shares.repartition(16, "share").mapInPandas(_sum_shares, "share int, levels binary")
    levels = np.zeros(cells, np.uint8)
    for row in summed.collect():
        levels[row["share"] * _SHARE : (row["share"] + 1) * _SHARE] = np.frombuffer(row["levels"], np.uint8)
    return levels


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-percent * n // 100)) + 1


def _order_key(tokens: np.ndarray, levels: np.ndarray, order: int) -> np.ndarray:
    high = levels[_cells(tokens, len(levels))].astype(np.uint64) << np.uint64(56)
    return high | (mixed(tokens, 100 + order) >> np.uint64(8))


def _distinct(token: np.ndarray, node: np.ndarray, *more: np.ndarray) -> list[np.ndarray]:
    """The columns sorted by token and node, one entry for each two."""
    by_token = np.lexsort((node, token))
    once = by_token[run_starts(token[by_token], node[by_token])]
    return [c[once] for c in (token, node, *more)]


def _combined(token: np.ndarray, node: np.ndarray, n: np.ndarray, place: np.ndarray, buckets: int) -> pd.DataFrame:
    """A row for each bucket; a token of many documents keeps the first and ties the others to it."""
    token, node, n, place = _distinct(token, node, n, place)
    starts = run_starts(token)
    lengths = np.diff(np.append(starts, len(token)))
    tied = np.repeat(lengths > FEW, lengths)
    first = np.zeros(len(token), bool)
    first[starts] = True
    stays, goes = first | ~tied, tied & ~first
    tie = np.repeat(node[starts], lengths)[goes]
    bucket = ((token >> np.uint64(_TOKEN_BITS + 2 - 32)) * np.uint64(buckets)) >> np.uint64(32)
    columns = [c[stays] for c in (token, node, n, place, tied)]
    cuts = run_starts(bucket[stays])
    names = bucket[stays][cuts]
    ends = np.append(cuts[1:], len(columns[0]))
    tie_cuts = np.searchsorted(bucket[goes], names), np.searchsorted(bucket[goes], names, "right")
    rows, ties = [], []
    for a, b, x, y in zip(cuts.tolist(), ends.tolist(), *(c.tolist() for c in tie_cuts)):
        own = [c[a:b] for c in columns]
        own[0] = np.diff(own[0], prepend=np.uint64(0))
        rows.append(packed(own, _PACKED))
        two = _distinct(node[goes][x:y], tie[x:y]) if x < y else (node[:0], node[:0])
        ties.append(packed(two, (np.int64, np.int64)))
    return pd.DataFrame({"bucket": names.astype(np.int64), "entries": rows, "ties": ties})


def _marked(bits: np.ndarray, digest: bytes) -> bool:
    return bool(has_bits(bits, np.array([_node(digest)]))[0])


def _prefixes(size: int, percent: int, levels, orders: range, buckets: int, partnered=None):
    """Prefix tokens under the given orders, with their places; the order is in a token's low bits."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = levels.value
        held: list[tuple] = []
        count = 0

        def flush() -> pd.DataFrame:
            parts = [np.concatenate([h[k] for h in held]) for k in range(4)]
            held.clear()
            return _combined(*parts, buckets)

        for batch in batches:
            for words in text_words(batch["text"]):
                tokens = shingle_set(words, size)
                n = len(tokens)
                if n == 0:
                    continue
                digest = _digest(tokens)
                if partnered is not None and not _marked(partnered.value, digest):
                    continue
                p, node = prefix_length(n, percent), np.array([_node(digest)])
                for order in orders:
                    key = _order_key(tokens, table, order)
                    chosen = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
                    chosen = tokens[chosen[np.argsort(key[chosen])]]
                    named = (chosen >> np.uint64(64 - _TOKEN_BITS) << np.uint64(2)) | np.uint64(order)
                    held.append((named, np.repeat(node, p), np.full(p, n, np.uint32), np.arange(p, dtype=np.uint32)))
                    count += p
                if count >= _FLUSH:
                    yield flush()
                    count = 0
        if held:
            yield flush()

    return emit


def _pair_up(percent: int):
    """(mask, a, b): the order's bit for documents that share a token of few, ``TIE`` for ties."""

    def paired(token: np.ndarray, node: np.ndarray, n: np.ndarray, place: np.ndarray, tied: np.ndarray) -> list[pd.DataFrame]:
        starts = run_starts(token)
        lengths = np.diff(np.append(starts, len(token)))
        run = np.repeat(np.arange(len(starts)), lengths)
        crowd = (np.logical_or.reduceat(tied, starts) | (lengths > FEW))[run]
        out = [_pairs(np.full(crowd.sum(), TIE, np.int8), node[crowd], node[starts][run][crowd])]
        mask = np.int8(1) << (token & np.uint64(3)).astype(np.int8)
        n = n.astype(np.int64)
        left = n - place
        for apart in range(1, min(FEW, int(lengths.max()))):
            x = np.flatnonzero((run[apart:] == run[:-apart]) & ~crowd[apart:])
            y = x + apart
            # What both sets still hold from the shared token on has to make up the intersection.
            least = -(-percent * (n[x] + n[y]) // (100 + percent))
            x, y = (z[np.minimum(left[x], left[y]) >= least] for z in (x, y))
            out.append(_pairs(mask[x], node[x], node[y]))
        return out

    def pair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, ["bucket"]):
            for a, b in slices(frame, ["bucket"]):
                parts = [unpacked(x, _PACKED) for x in frame["entries"].iloc[a:b]]
                token = np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts])
                node, n, place, tied = (np.concatenate([p[k] for p in parts]) for k in range(1, 5))
                # Of a document's entries for a token, one that is tied goes first.
                by_tie = np.argsort(1 - tied, kind="stable")
                columns = _distinct(*(c[by_tie] for c in (token, node, n, place, tied.astype(bool))))
                ties = [unpacked(x, (np.int64, np.int64)) for x in frame["ties"].iloc[a:b] if x]
                out = paired(*columns) + [_pairs(np.full(len(x), TIE, np.int8), x, y) for x, y in ties]
                yield pd.concat(out, ignore_index=True).drop_duplicates()

    return pair


def _pairs(mask: np.ndarray, x: np.ndarray, y: np.ndarray) -> pd.DataFrame:
    apart = x != y
    low, high = np.minimum(x, y), np.maximum(x, y)
    return pd.DataFrame({"mask": mask[apart], "a": high[apart], "b": low[apart]})


def _pair_counts(rows: np.ndarray, lengths: np.ndarray, m: int) -> np.ndarray:
    """How many short columns each two rows share; ``rows`` holds the columns one after another."""
    starts = np.cumsum(lengths) - lengths
    total = np.zeros(m * m, np.int64)
    for length in np.unique(lengths).tolist():
        first, second = np.triu_indices(length, 1)
        members = rows[starts[lengths == length][:, None] + np.arange(length)]
        step = max(1, _FLUSH // len(first))
        for k in range(0, len(members), step):
            part = members[k : k + step]
            total += np.bincount((part[:, first] * m + part[:, second]).ravel(), minlength=m * m)
    both = total.reshape(m, m)
    return both + both.T


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets, the diagonal left open.

    Only tokens that more than one set has count. Those of few sets are counted pair by pair,
    the others by a matrix product, whose cost does not depend on how many sets have one.
    """
    m = len(sets)
    if m == 2:
        both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], np.int64)
    tokens = np.concatenate(sets)
    rows = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(tokens, kind="stable")
    tokens, rows = tokens[order], rows[order]
    starts = run_starts(tokens)
    lengths = np.diff(np.append(starts, len(tokens)))
    few = (lengths > 1) & (lengths <= max(2, m // _SPARSE))
    total = _pair_counts(rows[np.repeat(few, lengths)], lengths[few], m)
    many = (lengths > 1) & ~few
    column = np.repeat(np.arange(many.sum()), lengths[many])
    rows = rows[np.repeat(many, lengths)]
    edges = np.arange(0, many.sum() + _COLUMNS, _COLUMNS)
    cuts = np.searchsorted(column, edges)
    for base, a, b in zip(edges, cuts[:-1], cuts[1:]):
        if a < b:
            dense = np.zeros((m, _COLUMNS), np.float32)
            dense[rows[a:b], column[a:b] - base] = 1
            total += np.rint(dense @ dense.T).astype(np.int64)
    return total


def linked(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets link: 100 * intersection >= percent * union."""
    n = np.array([len(s) for s in sets], np.int64)
    common = _common(sets)
    out = 100 * common >= percent * (n[:, None] + n[None, :] - common)
    np.fill_diagonal(out, False)
    return out


def tree(links: np.ndarray, ids: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id of its component) for all linked rows but those smallest ones."""
    left = set(np.flatnonzero(links.any(axis=1)).tolist())
    out = []
    while left:
        seen = {left.pop()}
        edge = list(seen)
        while edge:
            near = set(np.flatnonzero(links[edge].any(axis=0)).tolist()) - seen
            seen |= near
            edge = list(near)
        left -= seen
        root = ids[list(seen)].min()
        out += [(int(ids[k]), int(root)) for k in seen if ids[k] != root]
    return out


def _verify(size: int, percent: int):
    keys = ["family", "grp", "one", "two"]

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, keys):
            ids = frame["doc_id"].to_numpy()
            edges: list[tuple[int, int]] = []
            for a, b in slices(frame, keys):
                if b - a > 1:
                    sets = [shingle_set(w, size) for w in text_words(frame["text"].iloc[a:b])]
                    wanted = frame["digest"].iloc[a:b]
                    same = np.array([_digest(s) == bytes(d) for s, d in zip(sets, wanted)])
                    sets = [s for s, keep in zip(sets, same) if keep]
                    if len(sets) > 1:
                        edges += tree(linked(sets, percent), ids[a:b][same])
            yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return verify


def _found(docs: DataFrame, emit, percent: int, buckets: int) -> DataFrame:
    """(a, b, mask): the orders under which two documents are a pair, and whether they are tied."""
    prefixes = docs.select("text").mapInPandas(emit, "bucket long, entries binary, ties binary")
    # Rows are wide: a task gets a few buckets, whatever the session's partitions and the input.
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), buckets // TASK_BUCKETS)
    dealt = prefixes.repartition(parts, "bucket").sortWithinPartitions("bucket")
    pairs = dealt.mapInPandas(_pair_up(percent), "mask byte, a long, b long")
    return durable(pairs.groupBy("a", "b").agg(F.bit_or("mask").alias("mask")))


def _groups(docs: DataFrame, levels, size: int, percent: int, buckets: int) -> DataFrame:
    """(node, family, grp): groups of pairs that pass every order, and groups of ties."""
    first = _found(docs, _prefixes(size, percent, levels, range(1), buckets), percent, buckets)
    ends = first.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    others = _found(docs, _prefixes(size, percent, levels, range(1, ORDERS), buckets, bitmap(ends, FILTER_BITS)), percent, buckets)
    both = first.unionByName(others)
    every = both.groupBy("a", "b").agg(F.bit_or("mask").alias("mask")).where(F.expr(f"mask & {TIE - 1} = {TIE - 1}"))
    pairs = components(every.select("a", "b"))
    ties = components(both.where(F.expr(f"mask & {TIE} <> 0")).select("a", "b"))
    named = [
        g.select("node", F.lit(k).alias("family"), F.col("component").alias("grp")) for k, g in enumerate((pairs, ties))
    ]
    return durable(named[0].unionByName(named[1]))


def _of_nodes(size: int, nodes):
    def of_nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = []
            for words in text_words(batch["text"]):
                tokens = shingle_set(words, size)
                keep.append(len(tokens) > 0 and _marked(nodes.value, _digest(tokens)))
            yield batch[np.array(keep, bool)]

    return of_nodes


def _tiles(docs: DataFrame, wanted: DataFrame, nodes, size: int) -> DataFrame:
    """The text of every wanted document once for each tile of its groups."""
    sizes = wanted.groupBy("family", "grp").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("tokens"))
    chunks = F.greatest(F.ceil(F.col("docs") / TILE_DOCS), F.ceil(F.col("tokens") / TILE_SHINGLES)).cast("int")
    placed = durable(wanted.join(sizes.select("family", "grp", chunks.alias("chunks")), ["family", "grp"]))
    texts = docs.where("doc_id IS NOT NULL").mapInPandas(_of_nodes(size, nodes), "doc_id long, text string")
    own = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    spread = texts.join(placed, "doc_id").withColumn("own", own).withColumn("other", other)
    keys = ["family", "grp", "one", "two"]
    # A tile of two parts compares each part with itself too, so one part alone needs a tile
    # only where it is the whole group.
    tiles = spread.where("chunks = 1 OR own <> other").select(
        "doc_id",
        "text",
        "digest",
        "family",
        "grp",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
    )
    return tiles.repartition(*keys).sortWithinPartitions(*keys)


def ngram_join(
    docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Link documents whose word-shingle sets have a Jaccard of ``percent`` or more.

    Words are runs of characters other than space and \\t to \\r, A-Z lowered. A set holds
    the distinct shingles of ``size`` words; a text with fewer words has one shingle, the
    whole sequence. Returns (doc_id, n_shingles, component_id), one row per input row,
    component_id being the smallest id reachable by links.

    NULL and empty texts and texts of white space alone have an empty set, link with nothing
    and are their own component. Equal sets always link, so copies share a component. Rows
    that repeat an id stay rows of their own; links count for the id. A row with a NULL id
    takes the component of its equals, or NULL. Other columns are ignored. An empty table
    gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    cells = sketch_cells(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    scan = rows.withColumn("doc_id", id_text("doc_id")).mapInPandas(
        _scan(size, cells), "doc_id string, n long, digest binary, share int, counts binary"
    )
    scanned = written(scan, "scan")
    shares = scanned.where("share IS NOT NULL").select("share", "counts")
    levels = docs.sparkSession.sparkContext.broadcast(_levels(shares, cells))
    members = scanned.where("share IS NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "n", "digest")
    classes = durable(
        members.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"))
    )
    held = members.agg(F.sum("n"), F.count(F.lit(1))).first()
    prefixes = prefix_length(held[0] or 0, percent) + held[1]
    groups = _groups(rows, levels, size, percent, max(LEAST_BUCKETS, prefixes // BUCKET))
    wanted = classes.where("rep IS NOT NULL").withColumn("node", _node_column(F.col("digest"))).join(groups, "node")
    wanted = wanted.select(F.col("rep").alias("doc_id"), "digest", "n", "family", "grp")
    tiles = _tiles(rows, wanted, bitmap(groups.select("node").distinct(), FILTER_BITS), size)
    labels = components(tiles.mapInPandas(_verify(size, percent), "a long, b long"))
    settled = durable(
        classes.join(labels.select(F.col("node").alias("rep"), "component"), "rep", "left").select(
            "digest", F.coalesce("component", "rep").alias("component")
        )
    )
    own = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return members.join(settled, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def _node_column(digest):
    """The same number as ``_node``, from a digest column."""
    text = F.hex(digest)
    pairs = [F.substring(text, 15 - 2 * k, 2) for k in range(8)]
    return F.conv(F.concat(*pairs), 16, -10).cast("long")
