"""Row lookups by key, day and hour; distinct keys and days; one variable's series."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.times import ntz
from .joins import enrich
from .series import allowed


def rows_for(df: DataFrame, key: str, value) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def table_rows(spark: SparkSession, name: str, code: str | None = None) -> DataFrame:
    """All rows of one of the three tables, or those of an airport."""
    rows = spark.table(allowed(name, tuple(C.TABLES)))
    return rows if code is None else rows_for(rows, "airport_code", code)


def at_hour(df: DataFrame, key: str, value, time: str, moment: dt.datetime) -> DataFrame:
    """Rows of a key within the hour that holds ``moment``, in time order.

    Written as a half-open range, which reaches the scan; ``hour()`` would not.
    """
    start = moment.replace(minute=0, second=0, microsecond=0)
    within = (F.col(time) >= ntz(start)) & (F.col(time) < ntz(start + dt.timedelta(hours=1)))
    return rows_for(df, key, value).where(within).orderBy(time)


def at_hours(df: DataFrame, key: str, time: str, wanted: DataFrame, **bounds) -> DataFrame:
    """Rows that match any wanted (key, day, hour), all in one join."""
    placed = df.withColumns({"day": F.col(time).cast("date"), "hour": F.hour(time)})
    targets = wanted.select(key, "day", "hour").distinct()
    return enrich(placed, targets, [key, "day", "hour"], "left_semi", **bounds).drop("day", "hour")


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct().orderBy(key)


def distinct_days(df: DataFrame, time: str) -> DataFrame:
    return df.select(F.col(time).cast("date").alias("day")).distinct().orderBy("day")


def series(
    df: DataFrame,
    key: str,
    time: str,
    variable: str,
    variables: Sequence[str],
    value=None,
) -> DataFrame:
    """(key, time, variable) in time order, for one key or for all of them."""
    chosen = df.select(key, time, allowed(variable, variables))
    if value is not None:
        return rows_for(chosen, key, value).orderBy(time)
    return chosen.orderBy(key, time)
