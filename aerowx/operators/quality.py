"""Integrity checks and table profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import enrich


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count ``n_rows``."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, **bounds) -> DataFrame:
    """Keys of ``child`` that ``parent`` lacks, with their row count ``n_rows``.

    Child rows are counted per key before the join, so a key with very many rows
    reaches it as one row. A NULL key refers to nothing and is no orphan.
    """
    counts = (
        child.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    parents = parent.select(key).distinct()
    return enrich(counts, parents, key, "left_anti", hot_rows=None, **bounds)


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text over its column's length."""
    return df.where(reduce(lambda a, b: a | b, [F.length(c) > n for c, n in limits.items()]))


def split_rejects(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejected rows with ``reject_reason``: the first rule that holds.

    A rule that comes out NULL does not hold. Every row is in exactly one of the two.
    """
    marked = df.withColumn("reject_reason", first_reason(reasons))
    good = marked.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.where(F.col("reject_reason").isNotNull())


def first_reason(reasons: Mapping[str, Column]) -> Column:
    return F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in reasons.items()])


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: position, type, row count and filled count.

    One aggregate per table gives all its counts.
    """
    return reduce(lambda a, b: a.union(b), [_profile(n, df) for n, df in tables.items()])


def profile_catalog(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The profile of every table the catalog lists."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    prefix = f"{database}." if database else ""
    return profile({n: spark.table(prefix + n) for n in names})


def _profile(name: str, df: DataFrame) -> DataFrame:
    filled = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), *filled)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(i + 1).alias("position"),
                F.lit(kind).alias("data_type"),
                F.col(f"n{i}").alias("filled_count"),
            )
            for i, (c, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select(
        F.lit(name).alias("table_name"), "row_count", F.explode(rows).alias("c")
    ).select(
        "table_name", "c.column_name", "c.position", "c.data_type", "row_count", "c.filled_count"
    )


def preview(df: DataFrame, rows: int = 20) -> DataFrame:
    return df.limit(rows)
