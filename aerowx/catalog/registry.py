"""Checked queries: each runs an operator over whole tables, next to the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with its SQL if there is one."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pixels(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a sparse raster: a user is a cell, an event type a band; small values masked."""
    return table(spark, folder, "events").select(
        F.col("ts").alias("scene_ts"),
        F.expr("cast(user_id div 10 as int)").alias("row"),
        (F.col("user_id") % 10).cast("int").alias("col"),
        F.col("event_type").alias("band"),
        F.when(F.col("value") >= 10, F.col("value")).alias("value"),
    )


PIXELS = """
    pixels AS (
        SELECT ts AS scene_ts, CAST(user_id // 10 AS INTEGER) AS "row",
               CAST(user_id % 10 AS INTEGER) AS "col", event_type AS band,
               CASE WHEN value >= 10 THEN value END AS value
        FROM events)
"""


def tiles(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings as dense 8×8 tiles."""
    return (
        table(spark, folder, "embeddings")
        .select(F.col("vec_id").alias("scene"), F.posexplode("embedding").alias("pos", "value"))
        .select(
            "scene",
            F.expr("cast(pos div 8 as int)").alias("row"),
            (F.col("pos") % 8).cast("int").alias("col"),
            "value",
        )
    )


TILES = """
    spread AS (
        SELECT vec_id AS scene, unnest(embedding) AS value,
               generate_subscripts(embedding, 1) - 1 AS pos
        FROM embeddings),
    tiles AS (
        SELECT scene, CAST(pos // 8 AS INTEGER) AS "row", CAST(pos % 8 AS INTEGER) AS "col", value
        FROM spread)
"""
