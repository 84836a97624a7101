import pytest
from pyspark.sql import functions as F

from aerowx.operators import joins, lookups, quality
from aerowx.operators.quality import split_rejects


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on key 0, a sixth without key."""
    return spark.range(1200).selectExpr(
        "id", "case when id % 3 = 0 then 0 when id % 6 = 1 then null else id % 40 end as k"
    ).cache()


@pytest.fixture(scope="module")
def keyed(spark):
    return spark.range(30).selectExpr("id as k", "concat('n', id) as name").cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_every_way_gives_the_plain_join(facts, keyed, rows, how):
    want = rows(facts.join(keyed, "k", how).select("id", "k"))
    assert rows(joins.enrich(facts, keyed, "k", how).select("id", "k")) == want
    spread = joins.enrich(facts, keyed, "k", how, max_rows=0, hot_rows=100)
    assert rows(spread.select("id", "k")) == want
    plain = joins.enrich(facts, keyed, "k", how, max_rows=0, hot_rows=None)
    assert rows(plain.select("id", "k")) == want
    assert spread.columns == facts.join(keyed, "k", how).columns


def test_the_bound_decides(spark, facts, keyed):
    assert joins.fits_broadcast(keyed)
    assert not joins.fits_broadcast(keyed, max_rows=29)
    assert not joins.fits_broadcast(keyed, max_bytes=100)
    assert joins.fits_broadcast(keyed.limit(0))
    with pytest.raises(ValueError):
        joins.enrich(facts, keyed, "k", "cross")


def test_hot_key_reaches_several_tasks(spark, facts, keyed):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = joins.enrich(facts, keyed, "k", "inner", max_rows=0, hot_rows=300)
        parts = found.where("k = 0").groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_listed_codes(spark, rows):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "code string")
    listed = spark.createDataFrame([("A",), ("A",), (None,)], "code string")
    for codes in (["A"], listed):
        assert rows(joins.keep_listed(df, "code", codes)) == [("A",)]
        assert rows(joins.drop_listed(df, "code", codes)) == [("B",), (None,)]


def test_orphans_are_counted_before_the_join(spark, facts, keyed, rows):
    found = quality.orphan_keys(facts, keyed, "k")
    plain = facts.where("k >= 30").groupBy("k").count()
    assert rows(found) == rows(plain)


def test_rejects_split(spark, rows):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, None)], "id int, v int")
    rules = {"missing": F.col("v").isNull(), "negative": F.col("v") < 0, "late": F.col("id") > 3}
    good, bad = split_rejects(df, rules)
    assert rows(good) == [(1, 5)]
    assert rows(bad.select("id", "reject_reason")) == [(2, "missing"), (3, "negative"), (4, "missing")]


def test_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (2, "x")], "id int, name string")
    assert rows(quality.profile({"t": df, "empty": df.limit(0)})) == [
        ("empty", "id", 1, "int", 0, 0),
        ("empty", "name", 2, "string", 0, 0),
        ("t", "id", 1, "int", 2, 2),
        ("t", "name", 2, "string", 2, 1),
    ]
    assert quality.preview(spark.range(50)).count() == 20


def test_hour_lookup_reaches_the_scan(spark, tmp_path, plan_of):
    import datetime as dt

    path = str(tmp_path / "t")
    spark.range(100).selectExpr(
        "'A' as code", "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 30 as int)) as t"
    ).write.parquet(path)
    found = lookups.at_hour(spark.read.parquet(path), "code", "A", "t", dt.datetime(2024, 1, 2, 3, 59))
    assert [r["t"].minute for r in found.collect()] == [0, 30]
    text = plan_of(found)
    assert "GreaterThanOrEqual(t,2024-01-02T03:00)" in text and "LessThan(t,2024-01-02T04:00)" in text
