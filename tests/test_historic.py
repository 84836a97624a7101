import datetime as dt

import pandas as pd
import pytest

from aerowx import contracts as C
from aerowx.operators import series
from aerowx.operators.conform import cast_to, rename_all, union_by_name, union_by_position
from aerowx.plans import historic as plan
from aerowx.sinks import write_partitioned
from aerowx.sources.files import monthly_files

NAMES = list(C.STAGING_NAMES)


def month(path, days, columns=NAMES, **cells):
    data = {n: ["50.5"] * len(days) for n in columns}
    data["Date"] = [str(d) for d in days]
    for column in ("max", "avg", "min"):
        if f"Humidity (%), {column}" in data:
            data[f"Humidity (%), {column}"] = ["85.0"] * len(days)
    data.update(cells)
    pd.DataFrame(data).to_parquet(path, index=False)


@pytest.fixture
def folder(tmp_path):
    month(tmp_path / "ACK_2023-1.parquet", [1, 2, 31])
    month(tmp_path / "ACK_2023-2.parquet", [1, 30])
    month(tmp_path / "ATL_2023-12.parquet", [5], **{"Precipitation (in)": ["--"]})
    month(tmp_path / "notes.parquet", [1])
    month(tmp_path / "BIH_2023-3.parquet", [7], columns=NAMES[:16])
    (tmp_path / "readme.txt").write_text("not a table")
    return str(tmp_path)


def test_files_to_contract(spark, folder, rows):
    table, rejected = plan.historic(plan.staged_from_files(spark, folder))
    assert table.schema.simpleString() == C.HISTORIC.simpleString()
    assert rows(table.select("airport_code", "date_recorded")) == [
        ("ACK", dt.date(2023, 1, 1)),
        ("ACK", dt.date(2023, 1, 2)),
        ("ACK", dt.date(2023, 1, 31)),
        ("ACK", dt.date(2023, 2, 1)),
        ("ATL", dt.date(2023, 12, 5)),
        ("BIH", dt.date(2023, 3, 7)),
    ]
    assert rows(rejected.select("Date", "reject_reason")) == [("1", "file name"), ("30", "date")]
    first = table.where("airport_code = 'ACK'").first()
    assert (first["humidity_avg"], first["temperature_max"]) == (85, 50.5)
    assert table.where("airport_code = 'ATL'").first()["precipitation"] is None
    assert table.where("airport_code = 'BIH'").first()["precipitation"] is None


def test_good_and_rejected_rows_are_all_rows(spark, folder):
    staged = plan.staged_from_files(spark, folder)
    table, rejected = plan.historic(staged)
    assert table.count() + rejected.count() == staged.count() == 8


def test_a_month_delivered_twice_is_appended_once(spark, folder, tmp_path_factory):
    from aerowx.sinks import new_rows

    again = tmp_path_factory.mktemp("again")
    month(again / "ACK_2023-1.parquet", [1, 2, 31])
    both = plan.staged_from_files(spark, folder).union(plan.staged_from_files(spark, str(again)))
    table, _ = plan.historic(both)
    keys = ["airport_code", "date_recorded"]
    once = new_rows(table, table.limit(0), keys)
    assert (table.count(), once.count()) == (9, 6)


def test_empty_folder_gives_a_typed_empty_table(spark, tmp_path):
    table, _ = plan.historic(monthly_files(spark, str(tmp_path)))
    assert table.count() == 0
    assert table.schema.simpleString() == C.HISTORIC.simpleString()


def test_one_scan_for_all_files(spark, folder):
    table, _ = plan.historic(plan.staged_from_files(spark, folder))
    plan_text = table._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("FileScan") == 1
    assert "Union" not in plan_text and "Exchange" not in plan_text


def test_partitioned_folders_prune(spark, folder, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    staged = plan.staged_from_files(spark, folder).where("airport_code IS NOT NULL")
    write_partitioned(staged.drop("file_path"), out)
    read = spark.read.parquet(out).where("airport_code = 'ACK' AND year_month = '2023-1'")
    assert read.count() == 3
    assert "PartitionFilters: [isnotnull(airport_code" in read._jdf.queryExecution().toString()


DAYS = [
    ("A", dt.date(2023, 1, 1), 10),  # a Sunday: the week of 26 December
    ("A", dt.date(2023, 1, 2), 20),
    ("A", dt.date(2023, 1, 4), 25),
    ("A", dt.date(2023, 1, 10), 30),
    ("A", dt.date(2023, 1, 24), None),  # 14 days on
    ("A", dt.date(2023, 1, 26), 7),
    ("A", dt.date(2023, 1, 30), 8),
    ("B", dt.date(2023, 1, 3), 1),
]


@pytest.fixture
def measured(spark):
    days = spark.createDataFrame(DAYS, "airport_code string, date_recorded date, humidity_avg int")
    return cast_to(days, C.HISTORIC)


def test_weekly_segments(measured, rows):
    found = plan.weekly_series(measured, "humidity_avg")
    assert rows(found.select("airport_code", "week", "avg_value", "segment", "variable")) == [
        ("A", dt.date(2022, 12, 26), 10.0, 1, "Humidity"),
        ("A", dt.date(2023, 1, 2), 22.5, 1, "Humidity"),
        ("A", dt.date(2023, 1, 23), 7.0, 2, "Humidity"),
        ("A", dt.date(2023, 1, 30), 8.0, 2, "Humidity"),
        ("A", dt.date(2023, 1, 9), 30.0, 1, "Humidity"),
        ("B", dt.date(2023, 1, 2), 1.0, 1, "Humidity"),
    ]


def test_lines_skip_gaps_and_single_points(measured, rows):
    found = plan.weekly_lines(measured, "humidity_avg", scale=2)
    assert rows(found) == [
        ("A", dt.date(2022, 12, 26), dt.date(2023, 1, 2), 10.0, 22.5),
        ("A", dt.date(2023, 1, 2), dt.date(2023, 1, 9), 22.5, 30.0),
        ("A", dt.date(2023, 1, 23), dt.date(2023, 1, 30), 7.0, 8.0),
    ]


def test_gap_flags(measured):
    weekly = series.weekly_mean(measured, "airport_code", "date_recorded", "humidity_avg")
    flags = series.with_gaps(weekly, "airport_code").orderBy("airport_code", "week")
    assert [r["gap"] for r in flags.collect()] == [False, False, True, False, None, None]


def test_summary_counts_every_point_once(measured, rows):
    weekly = series.weekly_mean(measured, "airport_code", "date_recorded", "humidity_avg")
    found = rows(series.segments(weekly, "airport_code").select("airport_code", "segment", "points"))
    assert found == [("A", 1, 3), ("A", 2, 2), ("B", 1, 1)]


def test_only_listed_variables(measured):
    with pytest.raises(ValueError):
        plan.weekly_series(measured, "precipitation")


def test_raw_rows_are_averaged_before_any_window(measured):
    text = plan.weekly_series(measured, "humidity_avg")._jdf.queryExecution().executedPlan().toString()
    window, partial = text.index("Window"), text.rindex("partial_avg")
    assert window < partial  # plans print from the last step to the first


def test_unions(spark, rows):
    one = spark.createDataFrame([(1, "a")], "id int, name string")
    two = spark.createDataFrame([("b", 2)], "name string, id int")
    three = spark.createDataFrame([(3,)], "id int")
    assert rows(union_by_name([one, two])) == [(1, "a"), (2, "b")]
    assert rows(union_by_name([one, three], fill_missing=True)) == [(1, "a"), (3, None)]
    assert rows(union_by_position([one, two.select("id", "name")])) == [(1, "a"), (2, "b")]
    assert union_by_name([], empty=one.limit(0)).columns == ["id", "name"]
    with pytest.raises(ValueError):
        union_by_name([])
    with pytest.raises(ValueError):
        rename_all(one, ["only"])
