"""Repeatable randomness: numbers drawn from a hash of a seed and key columns.

md5 rather than Spark's own hashes, so that another engine can reproduce a draw.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import col

HASH_BITS = 60


def seeded_hash(seed: int, *keys: Column | str) -> Column:
    """A bigint in [0, 2**60) fixed by the seed and the keys."""
    parts = [F.coalesce(col(k).cast("string"), F.lit("")) for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_interval(number: Column) -> Column:
    """A hash as a double in [0, 1)."""
    return number / F.lit(float(2**HASH_BITS))
