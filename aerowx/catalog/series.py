"""Weekly series on orders, and the historic job end to end on events."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import series
from ..plans.historic import historic, staged_from_pages, weekly_lines, weekly_series
from .registry import query, table

_WEEKLY = """
    weekly AS (
        SELECT o_custkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week,
               CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice) AS avg_value
        FROM orders GROUP BY ALL)
"""


def _weekly(spark, folder):
    orders = table(spark, folder, "orders")
    return series.weekly_mean(orders, "o_custkey", "o_orderdate", "o_totalprice", scale=2)


@query(f"WITH {_WEEKLY} SELECT * FROM weekly")
def weekly_avg(spark, folder):
    return _weekly(spark, folder)


@query(
    f"""
    WITH {_WEEKLY}, ahead AS (
        SELECT *, lead(week) OVER o AS next_week, lead(avg_value) OVER o AS next_value
        FROM weekly WINDOW o AS (PARTITION BY o_custkey ORDER BY week))
    SELECT o_custkey, week, avg_value, coalesce(next_week, week) AS next_week,
           coalesce(next_value, avg_value) AS next_value,
           CASE WHEN next_week IS NULL THEN 'last' WHEN next_week - week > 7 THEN 'gap'
                ELSE 'joined' END AS gap
    FROM ahead
    """
)
def gap_flags(spark, folder):
    """All points: the last of a series has no gap, and points to itself."""
    kind = F.when(F.col("gap").isNull(), "last").when(F.col("gap"), "gap").otherwise("joined")
    return series.with_gaps(_weekly(spark, folder), "o_custkey").select(
        "o_custkey",
        "week",
        "avg_value",
        F.coalesce("next_week", "week").alias("next_week"),
        F.coalesce("next_value", "avg_value").alias("next_value"),
        kind.alias("gap"),
    )


_SEGMENTED = f"""
    {_WEEKLY}, marked AS (
        SELECT *, CASE WHEN week - lag(week) OVER o <= 7 THEN 0 ELSE 1 END AS starts
        FROM weekly WINDOW o AS (PARTITION BY o_custkey ORDER BY week)),
    segmented AS (
        SELECT o_custkey, week, avg_value,
               CAST(sum(starts) OVER (PARTITION BY o_custkey ORDER BY week) AS INTEGER) AS segment
        FROM marked)
"""


@query(f"WITH {_SEGMENTED} SELECT * FROM segmented")
def gap_segments(spark, folder):
    return series.with_segments(_weekly(spark, folder), "o_custkey")


@query(
    f"""
    WITH {_SEGMENTED}
    SELECT o_custkey, segment, min(week) AS first_week, max(week) AS last_week, count(*) AS points
    FROM segmented GROUP BY ALL
    """
)
def segment_summary(spark, folder):
    return series.segments(_weekly(spark, folder), "o_custkey")


@query(
    f"""
    WITH {_WEEKLY}, ahead AS (
        SELECT o_custkey, week AS from_week, lead(week) OVER o AS to_week,
               avg_value AS from_value, lead(avg_value) OVER o AS to_value
        FROM weekly WINDOW o AS (PARTITION BY o_custkey ORDER BY week))
    SELECT * FROM ahead WHERE to_week - from_week <= 7
    """
)
def segment_edges(spark, folder):
    return series.edges(_weekly(spark, folder), "o_custkey")


def _staged(spark, folder):
    """Events as a month's text table per user: one row per day, some cells no numbers.

    The n-th reading is raised by n, so that no two columns of a row agree.
    """
    days = (
        table(spark, folder, "events")
        .groupBy(
            F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("airport_code"),
            F.to_date("ts").alias("d"),
        )
        .agg(
            F.max("value").alias("hi"),
            F.min_by("value", "event_id").alias("mid"),
            F.min("value").alias("lo"),
            F.count(F.lit(1)).alias("n"),
            F.max(F.floor("value")).alias("whole"),
        )
    )
    names = list(C.STAGING_NAMES)
    readings = ["hi", "mid", "lo", "hi", "mid", "lo", "whole", "whole", "whole"]
    readings += ["hi", "mid", "lo", "hi", "mid", "lo"]

    def raised(reading, n):
        text = (F.col(reading) + n).cast("string")
        return F.concat(text, F.lit(".0")) if reading == "whole" else text

    rain = F.when(F.col("n") > 3, F.lit("--")).otherwise(raised("lo", 16))
    day = F.when(F.col("n") == 1, F.lit("Max")).otherwise(F.dayofmonth("d").cast("string"))
    return days.select(
        "airport_code",
        F.concat_ws("-", F.year("d"), F.month("d")).alias("year_month"),
        day.alias(names[0]),
        *[raised(r, i).alias(names[i]) for i, r in enumerate(readings, 1)],
        rain.alias(names[16]),
    )


def _pages(spark, folder):
    """The same months as web pages: two tables of no use, then seven that belong side by side."""
    names = list(C.STAGING_NAMES)
    columns = [F.col(f"`{n}`").alias(f"c{i}") for i, n in enumerate(names)]
    days = _staged(spark, folder).select("airport_code", "year_month", *columns)
    # A month has 31 days at most.
    month = F.array_sort(F.collect_list(F.struct(*[f"c{i}" for i in range(len(names))])))

    def line(*texts):
        cells = [part for t in texts for part in (F.lit("<td> "), t, F.lit("\n</td>"))]
        return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))

    def html_table(first, width):
        rows = F.transform("month", lambda d: line(*[d[f"c{first + i}"] for i in range(width)]))
        head = line(*[F.lit(f"sub {i}") for i in range(width)])
        return F.concat(F.lit("<table>"), head, F.array_join(rows, ""), F.lit("</table>"))

    menu = F.lit("<table><tr><td>menu</td></tr></table>")
    tables = [html_table(first, 3) for first in range(1, 16, 3)]
    return days.groupBy("airport_code", "year_month").agg(month.alias("month")).select(
        F.concat_ws("/", "airport_code", "year_month").alias("url"),
        F.concat(menu, menu, html_table(0, 1), *tables, html_table(16, 1)).alias("html"),
        "airport_code",
        "year_month",
    )


_HISTORIC = """
    days AS (
        SELECT 'U' || user_id AS airport_code, CAST(ts AS DATE) AS date_recorded,
               max(value) AS hi, arg_min(value, event_id) AS mid, min(value) AS lo,
               CAST(max(floor(value)) AS INTEGER) AS whole, count(*) AS n
        FROM events GROUP BY user_id, CAST(ts AS DATE)),
    historic AS (
        SELECT airport_code, date_recorded,
               CAST(hi + 1 AS FLOAT) AS temperature_max, CAST(mid + 2 AS FLOAT) AS temperature_avg,
               CAST(lo + 3 AS FLOAT) AS temperature_min, CAST(hi + 4 AS FLOAT) AS dew_point_max,
               CAST(mid + 5 AS FLOAT) AS dew_point_avg, CAST(lo + 6 AS FLOAT) AS dew_point_min,
               whole + 7 AS humidity_max, whole + 8 AS humidity_avg, whole + 9 AS humidity_min,
               CAST(hi + 10 AS FLOAT) AS wind_speed_max, CAST(mid + 11 AS FLOAT) AS wind_speed_avg,
               CAST(lo + 12 AS FLOAT) AS wind_speed_min, CAST(hi + 13 AS FLOAT) AS pressure_max,
               CAST(mid + 14 AS FLOAT) AS pressure_avg, CAST(lo + 15 AS FLOAT) AS pressure_min,
               CASE WHEN n <= 3 THEN CAST(lo + 16 AS FLOAT) END AS precipitation
        FROM days WHERE n > 1)
"""


@query(f"WITH {_HISTORIC} SELECT * FROM historic")
def historic_table(spark, folder):
    return historic(_staged(spark, folder))[0]


@query(f"WITH {_HISTORIC} SELECT * FROM historic")
def historic_from_pages(spark, folder):
    return historic(staged_from_pages(_pages(spark, folder))[0])[0]


@query(f"WITH {_HISTORIC} SELECT airport_code, count(*) AS n_rows FROM days WHERE n = 1 GROUP BY 1")
def historic_rejects(spark, folder):
    rejected = historic(_staged(spark, folder))[1]
    return rejected.groupBy("airport_code").agg(F.count(F.lit(1)).alias("n_rows"))


_HISTORIC_WEEKLY = f"""
    {_HISTORIC}, weekly AS (
        SELECT airport_code, CAST(date_trunc('week', date_recorded) AS DATE) AS week,
               CAST(sum(CAST(humidity_avg AS DECIMAL(18,2))) AS DOUBLE) / count(humidity_avg) AS avg_value
        FROM historic GROUP BY ALL)
"""


@query(
    f"""
    WITH {_HISTORIC_WEEKLY}, marked AS (
        SELECT *, CASE WHEN week - lag(week) OVER o <= 7 THEN 0 ELSE 1 END AS starts
        FROM weekly WINDOW o AS (PARTITION BY airport_code ORDER BY week))
    SELECT airport_code, week, avg_value, 'Humidity' AS variable,
           CAST(sum(starts) OVER (PARTITION BY airport_code ORDER BY week) AS INTEGER) AS segment
    FROM marked
    """
)
def historic_series(spark, folder):
    return weekly_series(historic(_staged(spark, folder))[0], "humidity_avg", scale=2)


@query(
    f"""
    WITH {_HISTORIC_WEEKLY}, ahead AS (
        SELECT airport_code, week AS from_week, lead(week) OVER o AS to_week,
               avg_value AS from_value, lead(avg_value) OVER o AS to_value
        FROM weekly WINDOW o AS (PARTITION BY airport_code ORDER BY week))
    SELECT * FROM ahead WHERE to_week - from_week <= 7
    """
)
def historic_lines(spark, folder):
    return weekly_lines(historic(_staged(spark, folder))[0], "humidity_avg", scale=2)
