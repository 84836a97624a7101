"""Samples, strata, numbering and batches."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import numbers
from ..functions.hashing import seeded_hash
from ..operators import numbering, sampling
from ..operators.flow import at_most_parallel
from ..session import shared_folder
from ..sinks import batches
from ..training_files import read_set, write_set
from .registry import query, table


def _draw(seed: int, *keys: str) -> str:
    text = " || '|' || ".join([f"'{seed}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


@query(
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {_draw(7, 'o_orderkey')}, o_orderkey LIMIT 10"
)
def sample_k(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return sampling.sample_k(orders, 10, ["o_orderkey"], seed=7)


@query(
    f"""
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity FROM lineitem
    ORDER BY {_draw(4, 'l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber')},
             l_orderkey, l_partkey, l_suppkey, l_linenumber LIMIT 4000
    """
)
def sample_k_refined(spark, folder):
    """A sample whose border is found by counts of hashes; no task sorts more than the border."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    lines = table(spark, folder, "lineitem").select(*keys, "l_quantity")
    return sampling.sample_k(lines, 4000, keys, seed=4, one_task=50)


_BINS = """
    binned AS (
        SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CAST(month(l_shipdate) AS INTEGER) AS month,
               CAST(floor(least(greatest(l_quantity, 0), 30) / 30 * 9) AS INTEGER) AS precipitation_bin,
               CAST(floor(least(greatest(l_extendedprice / 10, 0), 6000) / 6000 * 9) AS INTEGER) AS elevation_bin
        FROM lineitem),
    strata AS (
        SELECT *, elevation_bin * 10 + precipitation_bin AS stratum FROM binned)
"""


def _strata(spark, folder):
    lines = table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_suppkey",
        F.month("l_shipdate").alias("month"),
        numbers.bin_of("l_quantity", 30, 10).alias("precipitation_bin"),
        numbers.bin_of(F.col("l_extendedprice") / 10, 6000, 10).alias("elevation_bin"),
    ).withColumn("stratum", numbers.stratum_of("elevation_bin", "precipitation_bin", 10))


@query(f"WITH {_BINS} SELECT * FROM strata")
def bin_values(spark, folder):
    return _strata(spark, folder)


_LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query(
    f"""
    WITH {_BINS}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY month, stratum
            ORDER BY {_draw(3, *_LINE)}, {", ".join(_LINE)}) AS rn FROM strata)
    SELECT month, stratum, {", ".join(_LINE)} FROM ranked WHERE rn <= 2
    """
)
def stratified_sample(spark, folder):
    picked = sampling.sample_per_group(
        _strata(spark, folder), ["month", "stratum"], 2, list(_LINE), seed=3
    )
    return picked.select("month", "stratum", *_LINE)


@query(
    f"""
    SELECT c_custkey, TIMESTAMP '2023-01-01 00:00:00'
           + to_microseconds({_draw(5, 'c_custkey')} % 31536000000000) AS "at"
    FROM customer
    """
)
def random_dates(spark, folder):
    ids = table(spark, folder, "customer").select("c_custkey")
    return sampling.random_dates(
        ids, ["c_custkey"], dt.datetime(2023, 1, 1), dt.datetime(2024, 1, 1), seed=5
    )


@query(
    """
    SELECT row_number() OVER (ORDER BY o_custkey, o_orderdate, o_orderkey) AS record_id,
           o_custkey, o_orderdate, o_orderkey
    FROM orders
    """
)
def surrogate_key(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return numbering.numbered(orders, ["o_custkey", "o_orderdate", "o_orderkey"])


@query(
    f"""
    WITH numbered AS (
        SELECT *, row_number() OVER (ORDER BY {_draw(1, 'event_id')}, event_id) - 1 AS n,
               count(*) OVER () AS total
        FROM events),
    batched AS (
        SELECT *, least(n // 23, greatest(total // 23 - 1, 0)) AS batch_id FROM numbered)
    SELECT batch_id, count(*) AS n_examples, min(event_id) AS first_id, max(event_id) AS last_id,
           string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY event_id) AS ids
    FROM batched GROUP BY batch_id
    """
)
def batch_examples(spark, folder):
    events = table(spark, folder, "events").select("event_id")
    mixed = events.withColumn("draw", seeded_hash(1, "event_id"))
    batched = numbering.with_batch(mixed, ["draw", "event_id"], 23)
    # A batch holds 45 events at most.
    ids = F.transform(F.array_sort(F.collect_list("event_id")), lambda i: i.cast("string"))
    return batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_examples"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.array_join(ids, ",").alias("ids"),
    )


@query(
    f"""
    WITH numbered AS (
        SELECT *, row_number() OVER (ORDER BY {_draw(2, 'vec_id')}, vec_id) - 1 AS n, count(*) OVER () AS total
        FROM embeddings),
    batched AS (
        SELECT *, least(n // 20, greatest(total // 20 - 1, 0)) AS batch_id FROM numbered),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY n) - 1 AS example,
               count(*) OVER (PARTITION BY batch_id) AS n_examples FROM batched),
    spread AS (
        SELECT batch_id, CAST(n_examples AS INTEGER) AS n_examples, CAST(example AS INTEGER) AS example,
               unnest(embedding) AS value, generate_subscripts(embedding, 1) - 1 AS pos, label FROM placed)
    SELECT batch_id, n_examples, example, CAST(pos AS INTEGER) AS pos, CAST(value AS FLOAT) AS value,
           CAST(label AS FLOAT) AS label
    FROM spread
    """
)
def training_files(spark, folder):
    """All 8 by 8 tiles as a committed set of files, read back value by value."""
    tiles = table(spark, folder, "embeddings").select(
        "vec_id",
        F.col("embedding").cast("array<float>").alias("inputs"),
        F.array(F.col("label").cast("float")).alias("labels"),
        seeded_hash(2, "vec_id").alias("example_no"),
    )
    batch = numbering.with_batch(tiles.select("example_no", "vec_id"), ["example_no", "vec_id"], 20)
    home = shared_folder(spark, "training-files")
    batched = batches(tiles.join(batch, ["example_no", "vec_id"]))
    write_set(at_most_parallel(batched, 10, "batch_id"), home, (8, 8, 1), (1, 1, 1))
    found = read_set(spark, home).select("batch_id", "n_examples", "labels", F.posexplode("inputs").alias("at", "value"))
    example = F.expr("at div 64").cast("int")
    return found.select(
        "batch_id", "n_examples", example.alias("example"), (F.col("at") % 64).alias("pos"), "value",
        F.get("labels", example).alias("label"),
    )
