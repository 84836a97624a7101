"""Casts, bins and exact means."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import col


def try_number(text: Column | str, kind: str) -> Column:
    """A tolerant cast: text that is no number (``\\N``, ``--``) gives NULL.

    Whole-number targets go through double, so ``85.0`` becomes 85.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return col(text).try_cast("double").try_cast(kind)
    return col(text).try_cast(kind)


def zero_if_null(value: Column | str, kind: str = "double") -> Column:
    return F.coalesce(col(value), F.lit(0).cast(kind))


def mean(value: Column | str, scale: int | None = None) -> Column:
    """The mean over a group, as a double.

    With ``scale`` the sum is taken in decimals of that scale: exact, and the same
    whatever order the rows arrive in. Use it for values with few decimals.
    """
    if scale is None:
        return F.avg(col(value))
    exact = F.sum(col(value).cast(f"decimal(18,{scale})")).cast("double")
    return F.when(F.count(col(value)) > 0, exact / F.count(col(value)))


def clamp(value: Column | str, low: float, high: float) -> Column:
    c = col(value)
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def bin_of(value: Column | str, high: float, bins: int) -> Column:
    """The bin 0..bins-1 of a value clamped to [0, high]."""
    scaled = clamp(col(value).cast("double"), 0.0, float(high)) / F.lit(float(high))
    return F.floor(scaled * F.lit(float(bins - 1))).cast("int")


def stratum_of(first_bin: Column | str, second_bin: Column | str, bins: int) -> Column:
    return col(first_bin) * F.lit(bins) + col(second_bin)


def class_of(value: Column | str, low: float, high: float, classes: int) -> Column:
    """The class 0..classes-1 of a value stretched over [low, high]."""
    place = (col(value).cast("double") - F.lit(low)) / F.lit(high - low) * F.lit(float(classes))
    # Cut down as a double: a far outlier, say a fill value, has no place among the integers.
    return clamp(F.floor(clamp(place, 0.0, float(classes - 1))), 0, classes - 1).cast("int")


def above(value: Column | str, threshold: float) -> Column:
    """The value where it exceeds the threshold, else NULL (masked)."""
    return F.when(col(value) > F.lit(threshold), col(value))
