"""Repeatable samples: exactly k rows, at most n per group, strata and dates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import HASH_BITS, seeded_hash
from ..functions.times import ntz

#: Rows that a sample may sort in one task, and hash bits that one pass of counts tells apart.
ONE_TASK = 100_000
STEP_BITS = 12


def sample_k(
    df: DataFrame, k: int, keys: Sequence[str], seed: int = 0, one_task: int = ONE_TASK
) -> DataFrame:
    """Exactly k rows (all, if there are fewer), chosen by a hash of their keys.

    Up to ``one_task`` rows the smallest hashes meet in one task. For more, counts of the hashes by
    their leading bits find where the k-th lies, then by the bits after those, until few
    rows remain at the border: a hash below it is taken where it stands, and only the border's rows
    are sorted. ``keys`` should tell rows apart; ``df`` is read once more for each step.
    """
    drawn = df.withColumn("_draw", seeded_hash(seed, *keys))
    if k <= one_task:
        return drawn.orderBy("_draw", *keys).limit(k).drop("_draw")
    low, wanted, bits, border = 0, k, HASH_BITS, drawn
    while bits and wanted:
        step = min(STEP_BITS, bits)
        bits -= step
        part = F.shiftright(F.col("_draw") - F.lit(low), bits).alias("part")
        counts = border.select(part).groupBy("part").count().orderBy("part").collect()
        if sum(r["count"] for r in counts) <= wanted:
            # Fewer rows than wanted: all of them.
            low, wanted = low + (1 << (bits + step)), 0
            break
        for r in counts:
            if r["count"] > wanted:
                break
            wanted -= r["count"]
        low += r["part"] << bits
        border = drawn.where((F.col("_draw") >= low) & (F.col("_draw") < low + (1 << bits)))
        if r["count"] <= one_task:
            break
    taken = drawn.where(F.col("_draw") < low)
    if wanted:
        taken = taken.unionByName(border.orderBy("_draw", *keys).limit(wanted))
    return taken.drop("_draw")


def _ranked(df: DataFrame, groups: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(order))


def at_most_per_group(
    df: DataFrame, group: str, limits: Mapping[str, int], order_by: Sequence[Column | str]
) -> DataFrame:
    """The first rows of each listed group, up to its own limit; other groups are left out.

    The largest limit bounds the rank as a constant, so that each task cuts its
    groups down before the shuffle.
    """
    by_group = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    listed = df.where(F.col(group).isin(list(limits)))
    return (
        _ranked(listed, [group], order_by)
        .where(F.col("_rank") <= max(limits.values()))
        .where(F.col("_rank") <= by_group[F.col(group)])
        .drop("_rank")
    )


def sample_per_group(
    df: DataFrame, groups: Sequence[str], n: int, keys: Sequence[str], seed: int = 0
) -> DataFrame:
    """At most n rows per group, chosen by a hash of their keys."""
    drawn = df.withColumn("_draw", seeded_hash(seed, *keys))
    return (
        _ranked(drawn, groups, ["_draw", *keys])
        .where(F.col("_rank") <= n)
        .drop("_rank", "_draw")
    )


def random_dates(
    ids: DataFrame,
    keys: Sequence[str],
    start: dt.datetime,
    end: dt.datetime,
    seed: int = 0,
    name: str = "at",
) -> DataFrame:
    """Give each id an even random moment in [start, end), to the microsecond."""
    span = (end - start) // dt.timedelta(microseconds=1)
    micros = seeded_hash(seed, *keys) % F.lit(span)
    seconds = (micros / F.lit(1_000_000)).cast("decimal(20,6)")
    zero = F.lit(0)
    return ids.withColumn(name, ntz(start) + F.make_dt_interval(zero, zero, zero, seconds))


def first_per_key(
    df: DataFrame, keys: Sequence[str], prefer: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the smallest by ``prefer``, then by all other columns.

    An aggregate, so repeated rows shrink to one in each task before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    lead = [c for c in (prefer or []) if c in rest]
    whole = F.struct(*lead, *[c for c in rest if c not in lead])
    best = df.groupBy(*keys).agg(F.min(whole).alias("_row"))
    picked = {c: F.col(f"_row.`{c}`") for c in rest}
    return best.select(*[picked.get(c, F.col(c)).alias(c) for c in df.columns])
