"""Consecutive numbers over a whole table, and batches cut from them."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Sampled keys for each range: ranges then differ in size by about a seventh.
KEYS_PER_RANGE = 50
_IN_PARTITION = (1 << 33) - 1


def key_sketch(df: DataFrame, order_by: Sequence[str], size: int) -> DataFrame:
    """The ``size`` keys with the least hashes, a fair sample of the distinct keys.

    Two sketches merge by keeping the least of both, which is how a top-k runs. Nothing in it
    depends on how rows are dealt out.
    """
    keys = df.select(*order_by).withColumn("_hash", F.xxhash64(*order_by))
    return keys.orderBy("_hash", *order_by).limit(size).drop("_hash")


def range_bounds(df: DataFrame, order_by: Sequence[str], ranges: int) -> Column:
    """Bounds that cut the keys of ``df`` into about equal ranges, as a value that no longer moves.

    Read once here, at most ``ranges`` keys; the column holds them as data of its own.
    """
    sketch = key_sketch(df, order_by, ranges * KEYS_PER_RANGE)
    whole = F.array_sort(F.collect_set(F.struct(*order_by)))
    step = F.greatest(F.lit(1), F.ceil(F.size("all") / F.lit(ranges))).cast("int")
    picked = F.expr("filter(all, (k, i) -> i > 0 AND i % step = 0)").alias("bounds")
    found = sketch.agg(whole.alias("all")).withColumn("step", step).select(picked)
    # An Arrow table of this size becomes a local relation, so no later pass looks at the rows again.
    return df.sparkSession.createDataFrame(found.toArrow(), found.schema).scalar()


def range_of(bounds: str, order_by: Sequence[str], ranges: int) -> Column:
    """How many of the bounds in a column are not above a row's key: a binary search, from the largest step down."""
    steps = [1 << k for k in reversed(range(max(1, ranges).bit_length()))]
    key = F.struct(*order_by)

    def further(at: Column, step: Column) -> Column:
        # Past the last bound there is NULL, which is no reason to go on.
        return F.when(F.get(F.col(bounds), at + step - 1) <= key, at + step).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), further)


def _placed(df: DataFrame, order_by: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Add ``_number``, 0-based in the given order, and ``_total``.

    Three passes and no copy: a sketch of the keys gives bounds, rows are counted per range, and
    each range is a partition that is sorted by itself and goes on from the count of the ranges before it. A
    recomputed pass meets the same bounds. One number per range passes through the driver.
    """
    if ranges is None:
        ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(df, order_by, ranges)
    narrow = df.select(*order_by).withColumn("_bounds", bounds)
    counted = narrow.select(range_of("_bounds", order_by, ranges).alias("_range")).groupBy("_range").count()
    rows = {r["_range"]: r["count"] for r in counted.collect()}
    sizes = [rows.get(k, 0) for k in range(max(rows, default=0) + 1)]
    before = list(accumulate(sizes, initial=0))
    offsets = F.array(*[F.lit(n).cast(T.LongType()) for n in before[:-1]])
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    return (
        df.withColumn("_bounds", bounds)
        .withColumn("_range", range_of("_bounds", order_by, ranges))
        .drop("_bounds")
        .repartitionById(len(sizes), "_range")
        .sortWithinPartitions(*order_by)
        .withColumn("_number", F.get(offsets, F.col("_range")) + place)
        .withColumn("_total", F.lit(before[-1]).cast(T.LongType()))
        .drop("_range")
    )


def numbered(
    df: DataFrame, order_by: Sequence[str], name: str = "record_id", start: int = 1
) -> DataFrame:
    """Number all rows in the given order, without gaps.

    ``order_by`` should be a key of the rows: then ranges of it split evenly, also
    where one leading value holds most of the table. ``df`` is computed three times,
    twice for its keys alone, and must come out alike each time.
    """
    return (
        _placed(df, order_by)
        .withColumn(name, F.col("_number") + F.lit(start))
        .drop("_number", "_total")
    )


def with_batch(
    df: DataFrame, order_by: Sequence[str], min_size: int, name: str = "batch_id"
) -> DataFrame:
    """Put rows into batches of ``min_size``; the rest joins the last batch.

    So a batch holds min_size to 2*min_size-1 rows, unless there are fewer in all.
    """
    batch = f"least(_number div {min_size}, greatest(_total div {min_size} - 1, 0L))"
    return _placed(df, order_by).withColumn(name, F.expr(batch)).drop("_number", "_total")
