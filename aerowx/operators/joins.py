"""Joins of a large table with a keyed one, safe against size and skew.

``enrich`` broadcasts the keyed side only after measuring it. A side that is too
large is shuffled, and the few keys that hold very many rows of the large table
are spread over several tasks. No row is dropped on either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20
HOT_ROWS = 10_000_000


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` against the broadcast bounds: one pass, two numbers back.

    Columns of fixed width count by their width, others by their JSON text. A bound
    of 0 says no without looking.
    """
    if max_rows <= 0:
        return False
    wide = [
        f.name
        for f in df.schema.fields
        if not isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType))
    ]
    width = F.lit(8 * len(df.columns))
    if wide:
        texts = F.to_json(F.struct(*[F.col(f"`{c}`") for c in wide]))
        width = width + F.octet_length(texts)
    rows, n_bytes = df.agg(F.count(F.lit(1)), F.sum(width.cast("bigint"))).first()
    return rows <= max_rows and (n_bytes or 0) <= max_bytes


def _salted(
    facts: DataFrame,
    keyed: DataFrame,
    on: list[str],
    how: str,
    hot_rows: int,
    spread_by: Sequence[str] | None,
) -> DataFrame:
    # A hot key has hot_rows rows of the facts at least, so there are no more of them than
    # rows / hot_rows; its pieces follow its rows, a quarter of hot_rows to each.
    hot = (
        facts.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") >= hot_rows)
        .select(*on, F.greatest(F.lit(2), F.ceil(4 * F.col("_rows") / hot_rows)).cast("int").alias("_hot"))
    )
    drawn = F.xxhash64(*(spread_by or facts.columns))
    # NULL keys match nothing, so they may go to any task.
    no_key = F.greatest(*[F.col(k).isNull().cast("int") for k in on], F.lit(0)) == 1
    left = facts.join(F.broadcast(hot), on, "left").withColumn(
        "_salt",
        F.when(no_key, F.pmod(drawn, F.lit(2**31 - 1)))
        .otherwise(F.coalesce(F.pmod(drawn, F.col("_hot")), F.lit(0)))
        .cast("int"),
    )
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_hot"), F.lit(1)) - 1)
    right = (
        keyed.join(F.broadcast(hot), on, "left")
        .withColumn("_salt", F.explode(copies))
        .drop("_hot")
    )
    return left.drop("_hot").join(right.hint("merge"), [*on, "_salt"], how).drop("_salt")


def enrich(
    facts: DataFrame,
    keyed: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    *,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    hot_rows: int | None = HOT_ROWS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join ``facts`` to ``keyed`` on equal key columns.

    ``how`` is inner, left, left_semi or left_anti. ``keyed`` should hold a key once.
    A key with at least ``hot_rows`` rows of ``facts`` is spread, which takes a count
    per key first; None skips that, for facts that hold each key a few times only.
    Name in ``spread_by`` columns that tell apart the rows of a hot key; by default
    all columns of ``facts`` do. The salt is a hash of them and not of a row's place, so
    that a task that runs again salts as before; rows alike in all columns therefore
    stay together, and are better counted or dropped first.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot enrich with a {how} join")
    if fits_broadcast(keyed, max_rows, max_bytes):
        return facts.join(F.broadcast(keyed), keys, how)
    # The hint keeps the planner from broadcasting on an estimate: it takes an
    # exploded side, for one, to be as small as its input.
    if hot_rows is None:
        return facts.join(keyed.hint("merge"), keys, how)
    return _salted(facts, keyed, keys, how, hot_rows, spread_by)


def keep_listed(df: DataFrame, key: str, codes: Sequence[str] | DataFrame, **bounds) -> DataFrame:
    """Rows whose key is in the list: a literal list, or a table with that column."""
    if isinstance(codes, DataFrame):
        return enrich(df, codes.select(key).distinct(), key, "left_semi", **bounds)
    return df.where(F.col(key).isin(list(codes)))


def drop_listed(df: DataFrame, key: str, codes: Sequence[str] | DataFrame, **bounds) -> DataFrame:
    """Rows whose key is not in the list. Rows without a key stay."""
    if isinstance(codes, DataFrame):
        return enrich(df, codes.select(key).distinct(), key, "left_anti", **bounds)
    return df.where(~F.col(key).isin(list(codes)) | F.col(key).isNull())
