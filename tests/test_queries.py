"""Every registered query against its SQL, over whole tables."""

from pathlib import Path

import pytest

import __spark_entry__ as spark_entry
import check
from aerowx.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    word, _, _ = check.compare(spark, con, name, FOLDER)
    assert word == "same"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_pairs_and_no_row_python(spark, plan_of, name):
    text = plan_of(spark_entry.queries()[name](spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text
    assert ("MapInArrow" in text) == (name in ("html_tables", "historic_from_pages"))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("weekly_avg", "o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz"),
        ("mosaic", "ts:timestamp_ntz,user_id:bigint,event_type:string,value:double"),
        ("distinct_keys", "user_id:bigint"),
        ("pk_duplicates", "l_orderkey:bigint,l_linenumber:int"),
        ("path_parts", "page_id:bigint,url:string"),
    ],
)
def test_only_needed_columns_are_read(spark, plan_of, name, columns):
    text = plan_of(spark_entry.queries()[name](spark, FOLDER))
    read = [line for line in text.splitlines() if line.startswith("ReadSchema")]
    assert read == [f"ReadSchema: struct<{columns}>"]


@pytest.mark.parametrize(
    "name, filters",
    [
        ("lookup_one_hour", ["EqualTo(event_type,click)", "LessThan(ts,2024-01-05T10:00)"]),
        ("scene_window", ["GreaterThanOrEqual(ts,2024-01-09T18:00)", "LessThan(ts,2024-01-10T18:00)"]),
        ("topk_per_group", ["In(c_mktsegment, [BUILDING,FURNITURE,MACHINERY])"]),
        ("rows_by_key", ["EqualTo(event_type,click)"]),
    ],
)
def test_filters_reach_the_scan(spark, plan_of, name, filters):
    text = plan_of(spark_entry.queries()[name](spark, FOLDER))
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    assert all(f in pushed for f in filters)
