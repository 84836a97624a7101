"""Database tables over JDBC, read and written with bounded parallel connections."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {"batchsize": "10000", "numPartitions": "16"}


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    split_by: str | None = None,
    low: int | None = None,
    high: int | None = None,
    parts: int = 16,
) -> DataFrame:
    """A whole table; with ``split_by``, a numeric column, in parallel range reads.

    A split needs the column's bounds: without them one connection would read all.
    """
    options = dict(properties or {})
    if split_by is None:
        return spark.read.jdbc(url, table, properties=options)
    if low is None or high is None or low >= high:
        raise ValueError(f"a read split by {split_by} needs its bounds, low below high")
    return spark.read.jdbc(
        url, table, split_by, low, high, numPartitions=parts, properties=options
    )


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Overwrite (the table is emptied but its definition stays) or append.

    ``numPartitions`` bounds the connections. A task that is tried again may insert
    its rows twice, so append into a staging table where that matters.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError("mode is 'overwrite' or 'append'")
    options = {**DEFAULTS, **(properties or {})}
    if mode == "overwrite":
        options.setdefault("truncate", "true")
    df.write.jdbc(url, table, mode, options)
