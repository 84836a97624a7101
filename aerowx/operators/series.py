"""Weekly series per key: means, gaps and unbroken segments.

Rows are averaged per key and week before any window, so a window partition holds
at most one row per week of history, however many rows a key has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import mean
from ..functions.times import days_between, week_start

GAP_DAYS = 7


def allowed(variable: str, variables: Sequence[str]) -> str:
    """The variable, if it is on the list."""
    if variable not in variables:
        raise ValueError(f"{variable!r} is not one of {', '.join(variables)}")
    return variable


def weekly_mean(
    df: DataFrame, key: str, day: str, variable: str, scale: int | None = None
) -> DataFrame:
    """(key, week, avg_value): the mean of a variable per key and Monday week."""
    return df.groupBy(key, week_start(day).alias("week")).agg(
        mean(variable, scale).alias("avg_value")
    )


def with_gaps(weekly: DataFrame, key: str) -> DataFrame:
    """Add ``next_week``, ``next_value`` and ``gap``: more than 7 days to the next point.

    A series' last point has no next one, and ``gap`` is NULL.
    """
    order = Window.partitionBy(key).orderBy("week")
    return weekly.withColumns(
        {
            "next_week": F.lead("week").over(order),
            "next_value": F.lead("avg_value").over(order),
        }
    ).withColumn("gap", days_between("next_week", "week") > GAP_DAYS)


def with_segments(weekly: DataFrame, key: str) -> DataFrame:
    """Add ``segment``: 1, 2, … along each series, rising after every gap."""
    order = Window.partitionBy(key).orderBy("week")
    before = F.lag("week").over(order)
    starts = (before.isNull() | (days_between("week", before) > GAP_DAYS)).cast("int")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        weekly.withColumn("_starts", starts)
        .withColumn("segment", F.sum("_starts").over(so_far).cast("int"))
        .drop("_starts")
    )


def edges(weekly: DataFrame, key: str) -> DataFrame:
    """One row per pair of neighbouring weeks without a gap: the line to draw."""
    return (
        with_gaps(weekly, key)
        .where(~F.col("gap"))
        .select(
            key,
            F.col("week").alias("from_week"),
            F.col("next_week").alias("to_week"),
            F.col("avg_value").alias("from_value"),
            F.col("next_value").alias("to_value"),
        )
    )


def segments(weekly: DataFrame, key: str) -> DataFrame:
    """One row per segment: first and last week, and number of points."""
    return (
        with_segments(weekly, key)
        .groupBy(key, "segment")
        .agg(
            F.min("week").alias("first_week"),
            F.max("week").alias("last_week"),
            F.count(F.lit(1)).alias("points"),
        )
    )
