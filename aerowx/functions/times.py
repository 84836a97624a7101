"""Dates and times without a zone; bad text gives NULL."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(moment: dt.datetime | str) -> Column:
    """A zone-free timestamp literal."""
    text = moment if isinstance(moment, str) else moment.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def compose_date(year_month: Column | str, day: Column | str) -> Column:
    """``2023-1`` and ``5`` to ``2023-1-5``; NULL if either is NULL."""
    return F.concat(col(year_month), F.lit("-"), F.trim(col(day)))


def parse_date(text: Column | str) -> Column:
    """A date from ``yyyy-M-d`` or ``yyyy-MM-dd``."""
    return F.try_to_date(col(text), "yyyy-M-d")


def parse_timestamp(text: Column | str) -> Column:
    """A zone-free timestamp from ``yyyy-MM-dd HH:mm:ss``."""
    c = col(text)
    exact = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}$")
    return F.when(exact, c.try_cast("timestamp_ntz"))


def compose_timestamp(day: Column | str, time: Column | str) -> Column:
    """A zone-free timestamp from ``yyyy-MM-dd`` and ``HH:mm``."""
    return parse_timestamp(F.concat(col(day), F.lit(" "), col(time), F.lit(":00")))


def week_start(moment: Column | str) -> Column:
    """The Monday of the week, as a date."""
    return F.trunc(col(moment).cast("date"), "week")


def shift_hours(moment: Column | str, hours: int | Column) -> Column:
    amount = F.lit(hours) if isinstance(hours, int) else hours
    return col(moment) + F.make_dt_interval(F.lit(0), amount, F.lit(0), F.lit(0))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(col(later), col(earlier))


def slot(moment: Column | str, per_day: int) -> Column:
    """The number of an equal slice of the day, counted from 1970-01-01."""
    days = F.datediff(col(moment).cast("date"), F.lit("1970-01-01").cast("date"))
    return days * F.lit(per_day) + F.floor(F.hour(col(moment)) / F.lit(24 // per_day)).cast("int")


def minute_label(moment: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm`` for titles."""
    return F.substring(col(moment).cast("string"), 1, 16)
