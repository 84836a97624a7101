import datetime as dt

import pytest
from pyspark.sql import functions as F

from aerowx.functions.hashing import seeded_hash, unit_interval
from aerowx.operators import numbering, raster, sampling


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_exactly_k_and_repeatable(spark):
    df = spark.range(1000)
    one = ids(sampling.sample_k(df, 10, ["id"], seed=1))
    assert len(set(one)) == 10
    assert one == ids(sampling.sample_k(df.repartition(7), 10, ["id"], seed=1))
    assert one != ids(sampling.sample_k(df, 10, ["id"], seed=2))
    assert len(ids(sampling.sample_k(spark.range(3), 10, ["id"]))) == 3


def test_draws_are_even(spark):
    mean = spark.range(20_000).selectExpr("avg(id)").first()[0]
    assert mean == 9999.5
    row = spark.range(20_000).select(unit_interval(seeded_hash(0, "id")).alias("u")).selectExpr(
        "avg(u)", "min(u)", "max(u)"
    ).first()
    assert abs(row[0] - 0.5) < 0.01 and row[1] >= 0 and row[2] < 1


def test_at_most_n_per_group_with_a_hot_group(spark):
    df = spark.range(9000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('g', id % 50)) as g")
    found = sampling.sample_per_group(df, ["g"], 2, ["id"])
    assert all(r["count"] <= 2 for r in found.groupBy("g").count().collect())
    text = found._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2  # before the shuffle and after it


def test_limits_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id", "if(id % 2 = 0, 'a', 'b') as g")
    found = sampling.at_most_per_group(df, "g", {"a": 3, "c": 5}, ["id"])
    assert ids(found) == [0, 2, 4]
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_dates_in_range(spark):
    start, end = dt.datetime(2023, 1, 1), dt.datetime(2023, 3, 1)
    found = [r["at"] for r in sampling.random_dates(spark.range(200), ["id"], start, end).collect()]
    assert all(start <= d < end for d in found)
    assert len(set(found)) == 200


def test_one_row_per_key(spark, rows):
    df = spark.createDataFrame(
        [(1, "b", 2.0), (1, "b", 2.0), (1, "a", 3.0), (2, None, 1.0), (None, "x", 0.0)],
        "k int, name string, v double",
    )
    assert rows(sampling.first_per_key(df, ["k"])) == [(1, "a", 3.0), (2, None, 1.0), (None, "x", 0.0)]
    assert (1, "b", 2.0) in rows(sampling.first_per_key(df, ["k"], prefer=["v"]))


@pytest.mark.parametrize("parts", [1, 7])
def test_numbers_are_consecutive_in_order(spark, parts):
    df = spark.range(5000).selectExpr("if(id % 3 = 0, 'HOT', concat('K', id % 11)) as k", "id").repartition(parts)
    found = numbering.numbered(df, ["k", "id"]).collect()
    ordered = sorted(found, key=lambda r: (r["k"], r["id"]))
    assert [r["record_id"] for r in ordered] == list(range(1, 5001))
    text = numbering.numbered(df, ["k", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in text


def test_hot_key_is_split_over_ranges(spark):
    # So few rows would be coalesced into one partition.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = numbering.numbered(spark.range(8000).selectExpr("'HOT' as k", "id"), ["k", "id"])
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 4000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("rows_, size, sizes", [
    (100, 20, [20] * 5), (119, 20, [20] * 4 + [39]), (19, 20, [19]), (20, 20, [20]), (0, 20, []),
])
def test_batches_have_a_least_size(spark, rows_, size, sizes):
    found = numbering.with_batch(spark.range(rows_), ["id"], size)
    counts = found.groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in counts] == sizes


def test_one_cell_per_stratum(spark):
    cells = spark.range(3000).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' as at", "cast(id div 60 as int) - 25 as row",
        "cast(id % 60 as int) - 30 as col", "if(id % 3 = 0, 7, cast(id % 5 as int)) as stratum",
    )
    found = raster.one_cell_per_stratum(cells, seed=4)
    assert found.groupBy("stratum").count().where("count > 1").count() == 0
    assert found.join(cells, ["at", "row", "col", "stratum"]).count() == found.count() == 6
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text


def test_numbers_follow_the_order_whatever_the_ranges_and_types(spark, plan_of):
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 'HOT', if(id % 7 = 0, null, concat('k', id % 50))) as k",
        "date_add(date'2023-01-01', cast(id % 11 as int)) as d",
        "if(id % 13 = 0, null, cast(id % 17 as double) / 4) as v",
        "id",
        "cast(id as decimal(12, 2)) as m",
    )
    order = ["k", "d", "v", "m"]
    want = [r.id for r in df.orderBy(*order).collect()]
    for parts in (1, 7):
        found = numbering.numbered(df.repartition(parts), order)
        assert [r.id for r in sorted(found.collect(), key=lambda r: r.record_id)] == want
        assert sorted(r.record_id for r in found.collect()) == list(range(1, 3001))
    text = plan_of(found)
    assert "RDDScan" not in text and "ExistingRDD" not in text and "SinglePartition" not in text


def test_ranges_are_even_and_stay_where_they_are(spark):
    df = spark.range(40_000).selectExpr("if(id % 3 = 0, 0, id % 10) as k", "id")
    sizes = []
    for parts in (2, 9):
        placed = df.repartition(parts).withColumn("b", numbering.range_bounds(df.repartition(parts), ["k", "id"], 8))
        ranges = placed.select(numbering.range_of("b", ["k", "id"], 8).alias("r")).groupBy("r").count()
        sizes.append(sorted(tuple(r) for r in ranges.collect()))
    assert sizes[0] == sizes[1] and len(sizes[0]) == 8
    assert max(n for _, n in sizes[0]) < 2 * min(n for _, n in sizes[0])


def test_numbering_nothing(spark):
    empty = spark.range(0)
    assert numbering.numbered(empty, ["id"]).count() == 0 and numbering.with_batch(empty, ["id"], 3).count() == 0


@pytest.mark.parametrize("k", [0, 1, 57, 700, 2999, 3000, 5000])
def test_a_refined_sample_is_the_sorted_one(spark, k):
    df = spark.range(3000).selectExpr("id", "id % 3 as part")
    plain = {r.id for r in sampling.sample_k(df, k, ["id"], seed=9).collect()}
    for one_task in (0, 5):
        refined = [r.id for r in sampling.sample_k(df, k, ["id"], seed=9, one_task=one_task).collect()]
        assert len(refined) == min(k, 3000) and set(refined) == plain


def test_a_refined_sample_of_equal_keys(spark):
    df = spark.range(500).selectExpr("id % 2 as k", "id")
    assert sampling.sample_k(df, 300, ["k"], one_task=0).count() == 300
