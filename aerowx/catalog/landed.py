"""What is written to a folder and read back: monthly files, partitions, JSON, pixels along a curve."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import sinks
from ..functions.times import ntz
from ..session import shared_folder
from ..sources import files
from .registry import PIXELS, pixels, query, table

_MONTH = r"month=([A-Z]+)_(\d{4}-\d{1,2})/"


@query(
    """
    SELECT o_orderkey, o_totalprice, c_mktsegment AS airport_code,
           concat(year(o_orderdate), '-', month(o_orderdate)) AS year_month, CAST(o_orderdate AS DATE) AS "Date"
    FROM orders JOIN customer ON c_custkey = o_custkey
    """
)
def monthly_folder(spark, folder):
    """A folder per code and month, other files among them, as one scan; code and month come from the path."""
    home = shared_folder(spark, "monthly")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, folder, "orders").join(customers, "o_custkey")
    day = F.col("o_orderdate")
    staged = orders.select(
        "o_orderkey",
        "o_totalprice",
        F.dayofmonth(day).cast("string").alias("Date"),
        F.concat("c_mktsegment", F.lit("_"), F.year(day), F.lit("-"), F.month(day)).alias("month"),
    )
    sinks.write_partitioned(staged, home, ["month"])
    sinks.write_json(customers, f"{home}/notes")
    schema = "o_orderkey bigint, o_totalprice double, Date string"
    return files.dated(files.monthly_files(spark, home, schema, _MONTH)).drop("file_path")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate, l_returnflag, l_linestatus FROM lineitem")
def partitioned_folder(spark, folder):
    """Lines in a folder per flag and status, rebalanced on the way, read back whole."""
    home = shared_folder(spark, "partitioned")
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate", "l_returnflag", "l_linestatus"]
    lines = table(spark, folder, "lineitem").select(*columns)
    sinks.write_partitioned(lines, home, ["l_returnflag", "l_linestatus"])
    return files.parquet(spark, home, lines.schema)


@query("SELECT * FROM orders")
def json_files(spark, folder):
    """All columns of all orders as JSON files and back under their schema, every digit kept."""
    home = shared_folder(spark, "json")
    orders = table(spark, folder, "orders")
    sinks.write_json(orders, home)
    return files.json_documents(spark, home, orders.schema, multiline=False).select(*orders.columns)


_BOX = (2, 14, 3, 8)
_FROM, _TO = dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 12)


@query(
    f"""
    WITH {PIXELS}
    SELECT * FROM pixels
    WHERE scene_ts >= TIMESTAMP '{_FROM}' AND scene_ts < TIMESTAMP '{_TO}'
      AND "row" BETWEEN {_BOX[0]} AND {_BOX[1]} AND "col" BETWEEN {_BOX[2]} AND {_BOX[3]}
    """
)
def curve_box(spark, folder):
    """One box of cells and three days out of pixels that are stored along a curve."""
    home = shared_folder(spark, "curve")
    scenes = pixels(spark, folder)
    sinks.write_by_curve(scenes, home, ("2024-01-01", 0, 0), files=32)
    stored = files.parquet(spark, home, scenes.schema)
    wanted = (F.col("scene_ts") >= ntz(_FROM)) & (F.col("scene_ts") < ntz(_TO))
    return stored.where(wanted & F.col("row").between(*_BOX[:2]) & F.col("col").between(*_BOX[2:]))
