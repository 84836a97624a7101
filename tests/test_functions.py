import datetime as dt

from pyspark.sql import functions as F

from aerowx.functions.geo import cell_index
from aerowx.functions.numbers import class_of
from aerowx import contracts as C
from aerowx.functions import numbers, text, times
from aerowx.operators.conform import columns_like

PATHS = [
    ("s3://b/weather/ACK_2023-1.parquet",),
    ("ATL_2023-12.parquet",),
    ("s3://b/ack_2023-1.parquet",),
    ("s3://b/ACK_2023-1.csv",),
    (None,),
]


def test_path_parts_in_code_and_in_sql(spark):
    df = spark.createDataFrame(PATHS, "path string")
    got = df.select(
        text.path_part("path", C.MONTHLY_FILE, 1), text.path_part("path", C.MONTHLY_FILE, 2)
    ).collect()
    want = [("ACK", "2023-1"), ("ATL", "2023-12"), (None, None), (None, None), (None, None)]
    assert [tuple(r) for r in got] == want
    text.register_path_functions(spark)
    df.createOrReplaceTempView("paths")
    found = spark.sql("SELECT path_code(path), path_month(path) FROM paths").collect()
    assert [tuple(r) for r in found] == want


def test_name_parts(spark):
    df = spark.createDataFrame([("ACK_2023-1.parquet",), ("notes.parquet",)], "n string")
    code, month = text.name_parts("n")
    assert [tuple(r) for r in df.select(code, month).collect()] == [("ACK", "2023-1"), (None, None)]


def test_titles(spark):
    df = spark.createDataFrame([("dew_point_avg",), ("HUMIDITY",), ("",)], "n string")
    assert [r[0] for r in df.select(text.label("n")).collect()] == ["Dew_point", "Humidity", ""]


def test_dates_and_times(spark):
    days = [("2023-1", "5"), ("2023-01", "05"), ("2023-2", "30"), ("2023-1", None), ("2023-1", "Max")]
    df = spark.createDataFrame(days, "m string, d string")
    got = [r[0] for r in df.select(times.parse_date(times.compose_date("m", "d"))).collect()]
    assert got == [dt.date(2023, 1, 5), dt.date(2023, 1, 5), None, None, None]
    moments = spark.createDataFrame([("2024-03-10 02:30:00",), ("2024-03-10",), ("x",)], "t string")
    got = [r[0] for r in moments.select(times.parse_timestamp("t")).collect()]
    assert got == [dt.datetime(2024, 3, 10, 2, 30), None, None]
    composed = moments.limit(1).select(times.compose_timestamp(F.lit("2024-03-10"), F.lit("18:00")).alias("t"))
    assert composed.first()[0] == dt.datetime(2024, 3, 10, 18)
    assert composed.select(times.minute_label("t")).first()[0] == "2024-03-10 18:00"
    assert composed.select(times.week_start("t")).first()[0] == dt.date(2024, 3, 4)


def test_tolerant_numbers(spark):
    df = spark.createDataFrame([("85.0",), ("\\N",), ("--",), ("7",), (None,), ("1e3",)], "x string")
    assert [r[0] for r in df.select(numbers.try_number("x", "int")).collect()] == [85, None, None, 7, None, 1000]
    assert [r[0] for r in df.select(numbers.try_number("x", "float")).collect()] == [85.0, None, None, 7.0, None, 1000.0]


def test_means(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    assert df.agg(numbers.mean("v", 2)).first()[0] == 0.3 / 2
    assert abs(df.agg(numbers.mean("v")).first()[0] - 0.15) < 1e-12
    assert df.where("v IS NULL").agg(numbers.mean("v", 2)).first()[0] is None


def test_wide_band_choice(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "row int, CMI_C01 int, CMI_C02 int, DQF_C01 int")
    assert columns_like(df, C.IMAGER_BANDS, "row").columns == ["row", "CMI_C01", "CMI_C02"]


def test_outliers_and_longer_names(spark):
    df = spark.createDataFrame([(1e20, "x/oldACK_2023-1.parquet"), (-1e20, "x/ACK_2023-1.parquet"), (7.0, "ACK_2023-1.parquet")], "v double, p string")
    rows = df.select(
        class_of("v", 0.0, 10.0, 5), cell_index("v", 0.0, 2.0), text.path_part("p", C.MONTHLY_FILE, 1)
    ).collect()
    assert [tuple(r) for r in rows] == [(4, None, None), (0, None, "ACK"), (3, 3, "ACK")]
