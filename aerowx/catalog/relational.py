"""Scans, projections, filters, joins and checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import contracts as C
from .. import sinks
from ..functions import numbers, text, times
from ..functions.geo import in_region
from ..ledger import Ledger
from ..operators import conform, joins, lookups, quality, regions, requests, sampling
from ..plans.airports import airport_map, airports
from ..session import shared_folder
from ..sources import files
from .registry import query, table

ORDERS = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string"
)


@query("SELECT * FROM orders")
def scan_parquet(spark, folder):
    return files.parquet(spark, f"{folder}/orders.parquet", ORDERS)


@query("SELECT o_orderkey, 'orders' AS stem, 'parquet' AS suffix FROM orders")
def file_provenance(spark, folder):
    # The path names the table whether it is one file or a folder of parts.
    rows = files.with_file(table(spark, folder, "orders"))
    pattern = r"([A-Za-z]+)\.([a-z]+)(/[^/]*)?$"
    return rows.select(
        "o_orderkey",
        text.path_part("file_path", pattern, 1).alias("stem"),
        text.path_part("file_path", pattern, 2).alias("suffix"),
    )


_PROFILED = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "lineitem": [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    ],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
}


def _profile_sql() -> str:
    kinds = (
        "CASE typeof(max({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
        "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
        "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE 'other' END"
    )
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, {i} AS position, "
        f"{kinds.format(c=c)} AS data_type, count(*) AS row_count, count({c}) AS filled_count FROM {t}"
        for t, columns in _PROFILED.items()
        for i, c in enumerate(columns, 1)
    )


@query(_profile_sql())
def table_profile(spark, folder):
    return quality.profile({name: table(spark, folder, name) for name in _PROFILED})


def _airport_records(spark, folder):
    """Customers as landed airport pages: JSON of one record each, some under the old code name."""
    code = F.col("c_custkey").cast("string")
    old = F.col("c_nationkey") % 2 == 0
    record = F.struct(
        F.when(old, code).alias("column_1"),
        F.when(~old, code).alias("airport_code"),
        F.col("c_name").alias("airport_name"),
        F.concat(F.lit("town "), code).alias("city_name"),
        F.col("c_mktsegment").alias("country_name"),
        F.substring("c_mktsegment", 1, 2).alias("country_code"),
        F.col("c_acctbal").alias("latitude"),
        (F.col("c_acctbal") / 2).alias("longitude"),
        F.col("c_nationkey").alias("world_area_code"),
        F.when(old, F.lit("\\N")).otherwise(code).alias("city_name_geo_name_id"),
        F.col("c_nationkey").cast("string").alias("country_name_geo_name_id"),
        F.struct(F.col("c_acctbal").alias("lon"), F.col("c_acctbal").alias("lat")).alias("coordinates"),
    )
    pages = table(spark, folder, "customer").select(
        F.to_json(F.struct(F.array(record).alias("results"))).alias("json")
    )
    return files.unwrap_airports(files.parse_documents(pages, "json", C.AIRPORT_PAGE))


_AIRPORTS = """
    airports AS (
        SELECT CAST(c_custkey AS VARCHAR) AS airport_code, c_name AS airport_name,
               'town ' || c_custkey AS city_name, c_mktsegment AS country_name,
               substr(c_mktsegment, 1, 2) AS country_code, c_acctbal AS latitude,
               c_acctbal / 2 AS longitude, c_nationkey AS world_area_code,
               CASE WHEN c_nationkey % 2 = 0 THEN -1 ELSE CAST(c_custkey AS INTEGER) END
                   AS city_name_geo_name_id,
               c_nationkey AS country_name_geo_name_id
        FROM customer)
"""


def _marked(table_):
    """A missing id as -1, which no id is."""
    return table_.na.fill(-1, ["city_name_geo_name_id"])


@query(f"WITH {_AIRPORTS} SELECT * FROM airports")
def project_airports(spark, folder):
    return _marked(airports(_airport_records(spark, folder), limits=None))


@query(
    f"""
    WITH {_AIRPORTS}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY country_name ORDER BY airport_code) AS rn,
               CASE country_name WHEN 'BUILDING' THEN 50 WHEN 'MACHINERY' THEN 20
                                 WHEN 'FURNITURE' THEN 10 ELSE 0 END AS most
        FROM airports)
    SELECT * EXCLUDE (rn, most) FROM ranked WHERE rn <= most
    """
)
def airports_per_country(spark, folder):
    return _marked(airports(_airport_records(spark, folder), _LIMITS))


@query(
    f"""
    WITH {_AIRPORTS}
    SELECT nullif(airport_code, '3') AS airport_code, airport_name, latitude, longitude, country_name
    FROM airports WHERE airport_code NOT IN ('ZWI', 'TEH', 'OIA', 'TCS', 'SZL', 'PUO', 'YUB', 'YTK')
    """
)
def airport_places(spark, folder):
    known = airports(_airport_records(spark, folder), limits=None)
    return airport_map(known.withColumn("airport_code", F.nullif("airport_code", F.lit("3"))))


@query(
    """
    SELECT l_orderkey AS order_code, l_quantity AS "Quantity (pcs), max",
           l_shipdate AS date_recorded, l_linenumber
    FROM lineitem
    """
)
def conform_columns(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_quantity", "l_shipdate", "l_linenumber"
    )
    return conform.rename(
        rows,
        {
            "l_orderkey": "order_code",
            "l_quantity": "Quantity (pcs), max",
            "l_shipdate": "date_recorded",
            "column_1": "not there",
        },
    )


@query(
    """
    SELECT l_partkey AS c1, l_extendedprice AS c2 FROM lineitem
    UNION ALL SELECT o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT s_suppkey, s_acctbal FROM supplier
    """
)
def union_positional(spark, folder):
    both = conform.union_by_position(
        [
            table(spark, folder, "lineitem").select("l_partkey", "l_extendedprice"),
            table(spark, folder, "orders").select("o_orderkey", "o_totalprice"),
            table(spark, folder, "supplier").select("s_suppkey", "s_acctbal"),
        ]
    )
    return conform.rename_all(both, ["c1", "c2"])


@query(
    """
    SELECT c_custkey AS code, c_name AS name, c_acctbal AS amount FROM customer
    UNION ALL SELECT p_partkey, p_name, p_retailprice FROM part
    """
)
def union_by_name(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey code", "c_name name", "c_acctbal amount"
    )
    parts = table(spark, folder, "part").selectExpr(
        "p_retailprice amount", "p_partkey code", "p_name name"
    )
    return conform.union_by_name([customers, parts])


@query(
    """
    SELECT c_custkey AS code, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS brand FROM customer
    UNION ALL SELECT p_partkey, NULL, p_brand FROM part
    """
)
def union_missing(spark, folder):
    customers = table(spark, folder, "customer").selectExpr(
        "c_custkey code", "c_mktsegment segment"
    )
    parts = table(spark, folder, "part").selectExpr("p_brand brand", "p_partkey code")
    return conform.union_by_name([customers, parts], fill_missing=True)


@query("SELECT * FROM events WHERE event_type = 'click'")
def rows_by_key(spark, folder):
    return lookups.rows_for(table(spark, folder, "events"), "event_type", "click")


@query(
    """
    SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS code FROM orders
    WHERE o_orderpriority NOT IN ('5-LOW', '3-MEDIUM')
    """
)
def exclude_codes(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("code")
    )
    return joins.drop_listed(orders, "code", ("5-LOW", "3-MEDIUM"))


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')
    """
)
def semi_working_codes(spark, folder):
    working = (
        table(spark, folder, "customer")
        .where(F.col("c_mktsegment") == "MACHINERY")
        .select(F.col("c_custkey").alias("o_custkey"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.keep_listed(orders, "o_custkey", working)


@query(
    """
    SELECT e.* FROM events e
    JOIN (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY user_id) w
      ON e.user_id = w.user_id AND date_trunc('hour', e.ts) = date_trunc('hour', w.first_ts)
    """
)
def lookup_day_hour(spark, folder):
    events = table(spark, folder, "events")
    first = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    wanted = first.select("user_id", F.to_date("first_ts").alias("day"), F.hour("first_ts").alias("hour"))
    return lookups.at_hours(events, "user_id", "ts", wanted)


@query(
    """
    SELECT * FROM events WHERE event_type = 'click'
      AND ts >= TIMESTAMP '2024-01-05 09:00:00' AND ts < TIMESTAMP '2024-01-05 10:00:00'
    """
)
def lookup_one_hour(spark, folder):
    return lookups.at_hour(
        table(spark, folder, "events"), "event_type", "click", "ts", dt.datetime(2024, 1, 5, 9, 30)
    )


@query("SELECT DISTINCT user_id FROM events")
def distinct_keys(spark, folder):
    return lookups.distinct_keys(table(spark, folder, "events"), "user_id")


@query("SELECT DISTINCT CAST(ts AS DATE) AS day FROM events")
def distinct_days(spark, folder):
    return lookups.distinct_days(table(spark, folder, "events"), "ts")


@query("SELECT user_id, ts, value FROM events")
def series_by_variable(spark, folder):
    return lookups.series(
        table(spark, folder, "events"), "user_id", "ts", "value", ("value", "event_id")
    )


@query(
    """
    SELECT o_custkey AS custkey, count(*) AS n_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
    GROUP BY o_custkey
    """
)
def fk_orphans(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"))
    customers = table(spark, folder, "customer").where(F.col("c_acctbal") >= 0)
    return quality.orphan_keys(
        orders, customers.select(F.col("c_custkey").alias("custkey")), "custkey"
    )


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows
    FROM lineitem GROUP BY ALL HAVING count(*) > 1
    """
)
def pk_duplicates(spark, folder):
    return quality.duplicate_keys(table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10 OR length(p_type) > 8
    """
)
def length_check(spark, folder):
    parts = quality.too_long(table(spark, folder, "part"), {"p_name": 10, "p_type": 8})
    return parts.select("p_partkey", "p_name")


@query(
    """
    SELECT o_orderkey, o_custkey, c_name, c_acctbal
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON o_custkey = c_custkey
    """
)
def enrich_broadcast(spark, folder):
    customers = (
        table(spark, folder, "customer")
        .where(F.col("c_acctbal") >= 0)
        .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_acctbal")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return joins.enrich(orders, customers, "o_custkey")


@query(
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, p_name, p_retailprice
    FROM lineitem JOIN (SELECT * FROM part WHERE p_size > 10) ON l_partkey = p_partkey
    """
)
def enrich_shuffled(spark, folder):
    """The way for a keyed side over the broadcast bound, with hot keys spread."""
    parts = (
        table(spark, folder, "part")
        .where(F.col("p_size") > 10)
        .select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_retailprice")
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return joins.enrich(lines, parts, "l_partkey", "inner", max_rows=0, hot_rows=35)


_LIMITS = {"BUILDING": 50, "MACHINERY": 20, "FURNITURE": 10}


@query(
    """
    SELECT c_custkey, c_mktsegment, c_acctbal FROM (
        SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) AS rn,
               CASE c_mktsegment WHEN 'BUILDING' THEN 50 WHEN 'MACHINERY' THEN 20
                                 WHEN 'FURNITURE' THEN 10 ELSE 0 END AS most
        FROM customer) WHERE rn <= most
    """
)
def topk_per_group(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return sampling.at_most_per_group(
        customers, "c_mktsegment", _LIMITS, [F.desc("c_acctbal"), "c_custkey"]
    )


@query(
    """
    SELECT o_orderkey,
           CAST(TRY_CAST(substr(o_orderpriority, 1, 1) || '.0' AS DOUBLE) AS INTEGER) AS level,
           TRY_CAST(o_orderpriority AS INTEGER) IS NULL AS no_number,
           coalesce(TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN '\\N'
                             ELSE CAST(o_custkey AS VARCHAR) END AS INTEGER), -1) AS id,
           TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN '--' ELSE CAST(o_totalprice AS VARCHAR) END AS FLOAT) AS price
    FROM orders
    """
)
def typed_cast(spark, folder):
    orders = table(spark, folder, "orders")
    level = F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0"))
    as_id = F.when(F.col("o_orderstatus") == "P", F.lit("\\N")).otherwise(
        F.col("o_custkey").cast("string")
    )
    as_price = F.when(F.col("o_orderstatus") == "F", F.lit("--")).otherwise(
        F.col("o_totalprice").cast("string")
    )
    return orders.select(
        "o_orderkey",
        numbers.try_number(level, "int").alias("level"),
        numbers.try_number("o_orderpriority", "int").isNull().alias("no_number"),
        F.coalesce(numbers.try_number(as_id, "int"), F.lit(-1)).alias("id"),
        numbers.try_number(as_price, "float").alias("price"),
    )


@query(
    """
    SELECT o_orderkey, CAST(try_strptime(
        year(o_orderdate) || '-' || month(o_orderdate) || '-' || (o_custkey % 31 + 1),
        '%Y-%-m-%-d') AS DATE) AS date_recorded
    FROM orders
    """
)
def parse_date(spark, folder):
    orders = table(spark, folder, "orders")
    year_month = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"))
    day = (F.col("o_custkey") % 31 + 1).cast("string")
    return orders.select(
        "o_orderkey", times.parse_date(times.compose_date(year_month, day)).alias("date_recorded")
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS parsed,
           date_trunc('minute', ts) AS composed
    FROM events
    """
)
def parse_timestamp(spark, folder):
    events = table(spark, folder, "events")
    written = F.col("ts").cast("string")
    bad = F.when(F.col("event_type") == "error", F.lit("2024-13-01 00:00:00"))
    return events.select(
        "event_id",
        times.parse_timestamp(F.coalesce(bad, F.substring(written, 1, 19))).alias("parsed"),
        times.compose_timestamp(F.substring(written, 1, 10), F.substring(written, 12, 5)).alias(
            "composed"
        ),
    )


@query(
    """
    SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN 0.0 ELSE value END AS rain_3hr
    FROM events
    """
)
def null_to_zero(spark, folder):
    reading = F.when(F.col("event_type") != "click", F.col("value"))
    rain = F.when(F.col("event_type") != "error", F.struct(reading.alias("3h")))
    events = table(spark, folder, "events").select("event_id", rain.alias("rain"))
    return events.select("event_id", numbers.zero_if_null("rain.`3h`").alias("rain_3hr"))


@query(
    """
    SELECT p_partkey, upper(substr(bare, 1, 1)) || lower(substr(bare, 2)) AS title
    FROM (SELECT p_partkey, replace(p_name, ' ring', '') AS bare FROM part)
    """
)
def label_text(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", text.label("p_name", " ring").alias("title")
    )


@query(
    """
    SELECT CAST(to_json({o_orderkey: o_orderkey, o_custkey: o_custkey,
                         o_orderpriority: o_orderpriority}) AS VARCHAR) AS json
    FROM orders
    """
)
def to_json_rows(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    return sinks.json_rows(orders)


@query(
    """
    WITH corners AS (
        SELECT n_nationkey AS region_id, n_nationkey * CAST(13 AS DOUBLE) - 170 AS x,
               n_nationkey * CAST(5 AS DOUBLE) - 75 AS y FROM nation),
    edges AS (
        SELECT region_id, unnest([
            {x1: x - 31.5, y1: y - 20.25, x2: x + 42.0, y2: y - 9.5}, {x1: x + 42.0, y1: y - 9.5, x2: x + 5.0, y2: y + 2.0},
            {x1: x + 5.0, y1: y + 2.0, x2: x + 20.0, y2: y + 37.0}, {x1: x + 20.0, y1: y + 37.0, x2: x - 31.5, y2: y - 20.25}
        ]) AS e FROM corners),
    places AS (
        SELECT c_custkey, c_acctbal / 25 - 180 AS lon, c_nationkey * CAST(6 AS DOUBLE) - 71.5 AS lat FROM customer)
    SELECT c_custkey, lon, lat, region_id FROM places CROSS JOIN edges
    GROUP BY ALL
    HAVING count(*) FILTER (
        ((e.y1 > lat) != (e.y2 > lat)) AND lon < (e.x2 - e.x1) / (e.y2 - e.y1) * (lat - e.y1) + e.x1) % 2 = 1
    """
)
def points_in_regions(spark, folder):
    """All customers' places against a dented polygon for each nation; the polygons overlap."""
    places = table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 25 - 180).alias("lon"),
        (F.col("c_nationkey") * F.lit(6.0) - F.lit(71.5)).alias("lat"),
    )
    x, y = F.col("n_nationkey") * F.lit(13.0) - 170, F.col("n_nationkey") * F.lit(5.0) - 75
    corners = [(-31.5, -20.25), (42.0, -9.5), (5.0, 2.0), (20.0, 37.0)]
    ring = F.array(*[F.struct((x + dx).alias("lon"), (y + dy).alias("lat")) for dx, dy in corners])
    polygons = table(spark, folder, "nation").select(F.col("n_nationkey").alias("region_id"), ring.alias("ring"))
    return regions.in_regions(places, polygons)


_GRID_URL = "https://weather.example.com/monthly/%s/date/%d-%d"


@query(
    """
    SELECT c_name AS code, CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month,
           printf('%d-%02d', y, m) AS year_month,
           printf('https://weather.example.com/monthly/%s/date/%d-%d', c_name, y, m) AS url
    FROM customer, unnest(generate_series(2022, 2023)) AS ys(y), unnest(generate_series(1, 12)) AS ms(m)
    """
)
def request_grid(spark, folder):
    codes = table(spark, folder, "customer").select(F.col("c_name").alias("code"))
    return requests.month_grid(codes, "code", 2022, 2023, _GRID_URL)


@query(
    """
    SELECT c_custkey, lon, lat,
           lon BETWEEN -140 AND -10 AND lat BETWEEN -60 AND 60 AS in_box,
           lat > 0 AND lat < 80 AND lon > lat - 100 AND lon < 100 - lat AS in_triangle
    FROM (SELECT c_custkey, c_acctbal / 25 - 180 AS lon,
                 c_nationkey * CAST(6 AS DOUBLE) - 71.5 AS lat FROM customer)
    """
)
def region_filter(spark, folder):
    places = table(spark, folder, "customer").select(
        "c_custkey",
        (F.col("c_acctbal") / 25 - 180).alias("lon"),
        (F.col("c_nationkey") * F.lit(6.0) - F.lit(71.5)).alias("lat"),
    )
    box = [(-140.0, 60.0), (-140.0, -60.0), (-10.0, -60.0), (-10.0, 60.0)]
    triangle = [(-100.0, 0.0), (100.0, 0.0), (20.0, 80.0), (-20.0, 80.0)]
    return places.select(
        "*",
        in_region("lon", "lat", box).alias("in_box"),
        in_region("lon", "lat", triangle).alias("in_triangle"),
    )


_ARRIVED = "TIMESTAMP '2024-01-15 00:00:00'"


@query(
    f"""
    WITH existing AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events
                      WHERE ts < {_ARRIVED} + INTERVAL 5 DAY),
    incoming AS (SELECT user_id, CAST(ts AS DATE) AS day, event_id, value FROM events
                 WHERE ts >= {_ARRIVED}),
    once AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY event_id) AS rn FROM incoming)
    SELECT user_id, day, event_id, value FROM once o WHERE rn = 1 AND NOT EXISTS (
        SELECT 1 FROM existing e WHERE e.user_id = o.user_id AND e.day = o.day)
    """
)
def append_dedup(spark, folder):
    rows = table(spark, folder, "events").select(
        "user_id", F.to_date("ts").alias("day"), "event_id", "value", "ts"
    )
    existing = rows.where(F.col("ts") < times.ntz("2024-01-20 00:00:00"))
    incoming = rows.where(F.col("ts") >= times.ntz("2024-01-15 00:00:00")).drop("ts")
    # Delivered twice.
    twice = incoming.union(incoming)
    return sinks.new_rows(twice, existing, ["user_id", "day"], prefer=["event_id"])


@query(
    f"""
    WITH delivered AS (
        SELECT 'one' AS batch, user_id, CAST(ts AS DATE) AS day, event_id, value FROM events
        WHERE ts < {_ARRIVED} + INTERVAL 5 DAY
        UNION ALL
        SELECT 'two', user_id, CAST(ts AS DATE), event_id, value FROM events WHERE ts >= {_ARRIVED}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, day ORDER BY batch, event_id) AS rn FROM delivered)
    SELECT batch, user_id, day, event_id, value FROM ranked WHERE rn = 1
    """
)
def append_ledger(spark, folder):
    """Two batches that overlap; the second comes three times, last with all events."""
    home = shared_folder(spark, "ledger")
    name = f"ledger_{home[-32:]}"
    rows = table(spark, folder, "events").select("user_id", F.to_date("ts").alias("day"), "event_id", "value", "ts")
    one = rows.where(F.col("ts") < times.ntz("2024-01-20 00:00:00")).drop("ts")
    two = rows.where(F.col("ts") >= times.ntz("2024-01-15 00:00:00")).drop("ts")
    ledger = Ledger(spark, name, home, ["user_id", "day"], prefer=["event_id"], buckets=8)
    added = [ledger.append(df, batch) for batch, df in (("one", one), ("two", two), ("two", two.union(two)), ("two", one.union(two)))]
    columns = ["user_id", "day", "event_id", "value"]
    return added[0].select(F.lit("one").alias("batch"), *columns).unionByName(added[-1].select(F.lit("two").alias("batch"), *columns))


@query(
    """
    SELECT event_id, CASE WHEN value > 200 THEN 'too large'
                          WHEN event_type = 'error' THEN 'failed'
                          WHEN k IS NULL THEN 'no number' END AS reject_reason
    FROM (SELECT *, TRY_CAST(CASE WHEN event_type = 'view' THEN '--'
                                  ELSE json_extract_string(props, '$.k') END AS INTEGER) AS k FROM events)
    """
)
def dead_letter(spark, folder):
    events = table(spark, folder, "events")
    number = F.when(F.col("event_type") == "view", F.lit("--")).otherwise(
        F.get_json_object("props", "$.k")
    )
    good, rejected = quality.split_rejects(
        events.withColumn("k", numbers.try_number(number, "int")),
        {
            "too large": F.col("value") > 200,
            "failed": F.col("event_type") == "error",
            "no number": F.col("k").isNull(),
        },
    )
    kept = good.select("event_id", F.lit(None).cast("string").alias("reject_reason"))
    return kept.union(rejected.select("event_id", "reject_reason"))
