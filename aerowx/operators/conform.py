"""Renames, casts, nested documents and unions to the target contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import try_number, zero_if_null
from ..functions.times import parse_timestamp


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that are there; others in the map are ignored."""
    return df.withColumnsRenamed(dict(names))


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename every column by position; the width must agree."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns, but {len(names)} names")
    return df.toDF(*names)


def columns_like(df: DataFrame, pattern: str, *keep: str) -> DataFrame:
    """The columns whose whole name matches the pattern, after those to keep."""
    return df.select(*keep, df.colRegex(f"`{pattern}`"))


def cast_to(df: DataFrame, contract: T.StructType) -> DataFrame:
    """One projection to the contract's columns, order and types.

    Text casts are tolerant; a column the input lacks is NULL.
    """
    have = dict(df.dtypes)

    def target(field: T.StructField) -> Column:
        kind = field.dataType.simpleString()
        if field.name not in have:
            return F.lit(None).cast(kind).alias(field.name)
        source = _quoted(field.name)
        if have[field.name] == kind:
            return source
        if isinstance(field.dataType, T.NumericType):
            return try_number(source, kind).alias(field.name)
        return source.try_cast(kind).alias(field.name)

    return df.select(*[target(f) for f in contract.fields])


def union_by_position(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.union(b), frames)


def union_by_name(
    frames: Sequence[DataFrame], empty: DataFrame | None = None, fill_missing: bool = False
) -> DataFrame:
    """UNION ALL by name; with no frame at all, the typed ``empty`` table."""
    parts = list(frames) or [empty]
    if parts[0] is None:
        raise ValueError("no frames and no empty table")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), parts)


def flatten_forecasts(documents: DataFrame) -> DataFrame:
    """Forecast documents to one row per forecast step, 26 columns.

    A document with an empty or missing list gives no rows. Missing rain is 0, an
    empty weather array gives NULL texts.
    """
    # A plain explode adds a filter on the list below it, and where documents are
    # parsed from text that filter parses each of them again.
    steps = (
        documents.select("city", F.posexplode_outer("list").alias("_pos", "step"))
        .where(F.col("_pos").isNotNull())
        .drop("_pos")
    )
    weather = F.get(F.col("step.weather"), F.lit(0))
    return steps.select(
        F.col("city.name").alias("airport_code"),
        parse_timestamp("step.dt_txt").alias("datetime_recorded"),
        F.col("step.main.temp").alias("temperature"),
        F.col("step.main.feels_like").alias("feels_like"),
        F.col("step.main.temp_min").alias("temperature_min"),
        F.col("step.main.temp_max").alias("temperature_max"),
        F.col("step.main.pressure").alias("pressure"),
        F.col("step.main.sea_level").alias("sea_level"),
        F.col("step.main.grnd_level").alias("ground_level"),
        F.col("step.main.humidity").alias("humidity"),
        weather["main"].alias("weather_main"),
        weather["description"].alias("weather_description"),
        F.col("step.clouds.all").alias("clouds_all"),
        F.col("step.wind.speed").alias("wind_speed"),
        F.col("step.wind.deg").alias("wind_deg"),
        F.col("step.wind.gust").alias("wind_gust"),
        F.col("step.visibility").alias("visibility"),
        F.col("step.pop").alias("pop"),
        zero_if_null("step.rain.`3h`").alias("rain_3hr"),
        F.col("step.sys.pod").alias("pod"),
        F.col("city.country").alias("country"),
        F.col("city.timezone").alias("timezone"),
        F.col("city.coordinates.lat").alias("latitude"),
        F.col("city.coordinates.lon").alias("longitude"),
        F.col("city.sunrise").alias("sunrise"),
        F.col("city.sunset").alias("sunset"),
    )


def drop_inside(df: DataFrame, struct: str, *fields: str) -> DataFrame:
    """Drop fields inside a struct column."""
    return df.withColumn(struct, F.col(struct).dropFields(*fields))


def set_inside(df: DataFrame, struct: str, values: Mapping[str, Column]) -> DataFrame:
    """Add or replace fields inside a struct column."""
    changed = reduce(lambda c, kv: c.withField(*kv), values.items(), F.col(struct))
    return df.withColumn(struct, changed)
