"""Near-duplicate vectors by cosine: tiles of vectors whose axes are ordered by PCA.

Unit vectors are turned onto the principal axes of the whole table, the widest first. Two
vectors of cosine t or more are at most sqrt(2 - 2 t) apart, so cells of that width on the
leading axes need comparing with their neighbours only. Within a tile the product of the
leading axes is summed first; what the others can add is at most the product of the two
remaining norms, and a pair is dropped as soon as that cannot lift it to t. The pairs left
are decided on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import enrich
from ..session import durable
from .components import components
from .ngram_join import tree
from .runs import slices, whole_runs
from .shared import id_text, written

#: Axes that cells are cut along, and vectors to a side of a tile.
CELL_AXES = 2
TILE_ROWS = 1024
#: Axes summed before the first bound, and the factor by which each further step grows.
FIRST_AXES = 8
#: Room for rounding when bounds are compared; the last decision does not use it.
SLACK = 1e-9


def _clean(blobs) -> np.ndarray | None:
    """The vector in double precision, or None where it can link with nothing."""
    if blobs is None:
        return None
    vector = np.array([np.nan if x is None else x for x in blobs], np.float64)
    if len(vector) == 0 or not np.isfinite(vector).all():
        return None
    size = np.abs(vector).max()
    return vector if size > 0 else None


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [_clean(v) for v in batch["embedding"]]
        yield pd.DataFrame(
            {
                "vec_id": batch["vec_id"],
                "label": batch["label"],
                "dims": [0 if v is None else len(v) for v in found],
                "vector": [None if v is None else v.tobytes() for v in found],
            }
        )


def _stacked(frame: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(frame["vector"]), np.float64).reshape(len(frame), -1)


def _moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for dims, part in batch.groupby("dims"):
            units = unit(_stacked(part))
            sums[dims] = sums.get(dims, 0) + units.T @ units
    rows = [(d, i, j, m[i, j]) for d, m in sums.items() for i in range(d) for j in range(d)]
    yield pd.DataFrame(rows, columns=["dims", "i", "j", "v"])


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes for each length of vector, widest first: dims x dims numbers each."""
    summed = vectors.mapInPandas(_moments, "dims int, i int, j int, v double").groupBy("dims", "i", "j")
    axes: dict[int, np.ndarray] = {}
    for row in summed.agg(F.sum("v").alias("v")).collect():
        axes.setdefault(row["dims"], np.zeros((row["dims"],) * 2))[row["i"], row["j"]] = row["v"]
    return {d: np.linalg.eigh(m)[1][:, ::-1] for d, m in axes.items()}


def _cells(axes, width: float):
    def cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dims, part in batch.groupby("dims"):
                lead = unit(_stacked(part)) @ axes.value[dims][:, :CELL_AXES]
                lead = np.pad(lead, ((0, 0), (0, CELL_AXES - lead.shape[1])))
                cell = np.floor((lead + 2) / width).astype(np.int32)
                yield part.assign(c0=cell[:, 0], c1=cell[:, 1])

    return cells


#: Each pair of neighbouring cells once: a cell meets itself and half of those around it.
HALF = [s for s in product((-1, 0, 1), repeat=CELL_AXES) if s >= (0,) * CELL_AXES]


def close_pairs(
    one: np.ndarray, two: np.ndarray, turned_one: np.ndarray, turned_two: np.ndarray, threshold: float
) -> np.ndarray:
    """Which rows of ``one`` and ``two`` reach the cosine, leading axes first."""
    dims = one.shape[1]
    cuts = []
    at = FIRST_AXES
    while at < dims:
        cuts.append(at)
        at *= 2
    cuts.append(dims)

    def rest(turned: np.ndarray) -> np.ndarray:
        tail = np.cumsum((turned**2)[:, ::-1], axis=1)[:, ::-1]
        return np.sqrt(np.maximum(np.pad(tail, ((0, 0), (0, 1))), 0))[:, cuts]

    rest_one, rest_two = rest(turned_one), rest(turned_two)
    first = turned_one[:, : cuts[0]] @ turned_two[:, : cuts[0]].T
    open_pairs = np.argwhere(first + np.outer(rest_one[:, 0], rest_two[:, 0]) >= threshold - SLACK)
    a, b = open_pairs[:, 0], open_pairs[:, 1]
    sums = first[a, b]
    for k in range(1, len(cuts)):
        low, high = cuts[k - 1], cuts[k]
        sums = sums + np.einsum("ij,ij->i", turned_one[a, low:high], turned_two[b, low:high])
        stay = sums + rest_one[a, k] * rest_two[b, k] >= threshold - SLACK
        a, b, sums = a[stay], b[stay], sums[stay]
    lengths_one = np.sqrt(np.einsum("ij,ij->i", one, one))
    lengths_two = np.sqrt(np.einsum("ij,ij->i", two, two))
    cosine = np.einsum("ij,ij->i", one[a], two[b]) / (lengths_one[a] * lengths_two[b])
    out = np.zeros((len(one), len(two)), bool)
    out[a, b] = cosine >= threshold
    return out


_TILE = ["label", "dims", "c0", "c1", "g0", "g1", "one", "two"]


def _compare(axes, threshold: float):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_runs(batches, _TILE):
            out: list[tuple[int, int, int]] = []
            for a, b in slices(frame, _TILE):
                part = frame.iloc[a:b]
                own = part["side"].to_numpy() == 0
                alone = all(part[x].iloc[0] == part[y].iloc[0] for x, y in (("c0", "g0"), ("c1", "g1"), ("one", "two")))
                if not own.any() or not (alone or (~own).any()):
                    continue
                vectors = _stacked(part)
                vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                turned = unit(vectors) @ axes.value[int(part["dims"].iloc[0])]
                ids = part["place"].to_numpy()
                other = own if alone else ~own
                links = close_pairs(vectors[own], vectors[other], turned[own], turned[other], threshold)
                if alone:
                    np.fill_diagonal(links, False)
                    square, names = links, ids
                    out += [(int(i), int(i), int(d)) for i, d in zip(ids, links.sum(1)) if d]
                else:
                    names = np.concatenate((ids[own], ids[other]))
                    n = int(own.sum())
                    square = np.zeros((len(names),) * 2, bool)
                    square[:n, n:], square[n:, :n] = links, links.T
                    out += [(int(i), int(i), int(d)) for i, d in zip(names, square.sum(1)) if d]
                out += [(x, y, 0) for x, y in tree(square, names)]
            yield pd.DataFrame(out, columns=["a", "b", "links"], dtype="int64")

    return compare


def embed_dedup(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Link vectors of equal label whose cosine is at least ``threshold`` (0 < threshold <= 1).

    Returns (vec_id, n_links, component_id, kept) for every input row: how many other rows
    it links with directly, the smallest id reachable by links, and whether that is its own.

    Vectors that are NULL, empty or zero, or hold NULL or non-finite components, and rows
    with a NULL label or a NULL id link with nothing; so do vectors of different length.
    Such a row is its own component (NULL where the id is). Equal vectors link, also where
    rows repeat an id: each row counts its links, and the id's rows share a component. Other
    columns are ignored. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    given = vectors.select(
        id_text(id_col).alias("vec_id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("embedding"),
    )
    read = given.mapInPandas(_read, "vec_id string, label string, dims int, vector binary")
    read = read.withColumn("vec_id", F.col("vec_id").cast("long"))
    rows = written(read.withColumn("place", F.monotonically_increasing_id()), "vectors")
    able = rows.where("dims > 0 AND label IS NOT NULL AND vec_id IS NOT NULL")
    axes = spark.sparkContext.broadcast(_axes(able))
    width = float(np.sqrt(2 - 2 * threshold)) + 1e-6
    placed = able.mapInPandas(
        _cells(axes, width), "vec_id long, label string, dims int, vector binary, place long, c0 int, c1 int"
    )
    placed = written(placed.drop("vec_id"), "cells")
    cell = ["label", "dims", "c0", "c1"]
    sizes = durable(placed.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / TILE_ROWS).cast("int").alias("chunks")))
    home = enrich(placed, sizes, cell, "inner", hot_rows=None).withColumn(
        "own", F.pmod(F.xxhash64("place"), F.col("chunks")).cast("int")
    )
    # A vector is on the near side of its own cell's tiles, and on the far side of tiles of
    # the cells that have it for a neighbour.
    steps = F.array(*[F.struct(F.lit(x).alias("s0"), F.lit(y).alias("s1")) for x, y in HALF])
    far = home.drop("chunks").withColumn("step", F.explode(steps))
    far = far.withColumn("g0", F.col("c0")).withColumn("g1", F.col("c1"))
    far = far.withColumn("c0", F.expr("c0 - step.s0")).withColumn("c1", F.expr("c1 - step.s1"))
    far = enrich(far, sizes, cell, "inner", hot_rows=None)
    same = F.expr("step.s0 = 0 AND step.s1 = 0")
    last = F.when(same, F.col("own")).otherwise(F.col("chunks") - 1)
    far = far.withColumn("one", F.explode(F.sequence(F.lit(0), last))).withColumn("two", F.col("own"))
    far = far.withColumn("side", F.when(same & (F.col("one") == F.col("two")), F.lit(0)).otherwise(F.lit(1)))
    reach = sizes.withColumn("step", F.explode(steps)).withColumnRenamed("chunks", "mine")
    around = sizes.select("label", "dims", F.col("c0").alias("g0"), F.col("c1").alias("g1"), "chunks")
    met = reach.withColumn("g0", F.expr("c0 + step.s0")).withColumn("g1", F.expr("c1 + step.s1"))
    met = durable(met.join(around, ["label", "dims", "g0", "g1"]).select(*cell, "g0", "g1", "chunks"))
    near = enrich(home.drop("chunks"), met.groupBy(*cell).agg(
        F.collect_list(F.struct("g0", "g1", "chunks")).alias("cells")), cell, "inner", hot_rows=None)
    near = near.withColumn("cell", F.explode("cells")).select("*", "cell.*").drop("cell", "cells")
    inside = F.expr("g0 = c0 AND g1 = c1")
    start = F.when(inside, F.col("own") + 1).otherwise(F.lit(0))
    tiles = F.when(start < F.col("chunks"), F.sequence(start, F.col("chunks") - 1))
    near = near.withColumn("two", F.explode(tiles)).withColumn("one", F.col("own")).withColumn("side", F.lit(0))
    columns = [*_TILE, "side", "place", "vector"]
    tiled = near.select(*columns).unionByName(far.select(*columns))
    found = durable(
        tiled.repartition(*_TILE).sortWithinPartitions(*_TILE).mapInPandas(
            _compare(axes, threshold), "a long, b long, links long"
        )
    )
    degrees = found.where("a = b").groupBy(F.col("a").alias("place")).agg(F.sum("links").alias("n_links"))
    ids = rows.select("place", "vec_id")
    trees = found.where("a <> b").select("a", "b")
    named = trees.join(ids.toDF("a", "x"), "a").join(ids.toDF("b", "y"), "b").select("x", "y")
    labels = components(named)
    result = ids.join(degrees, "place", "left").join(labels.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    component = F.coalesce("component", "vec_id")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("vec_id")).alias("kept"),
    )
