"""JSON documents, structs, arrays and the forecast job."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import conform
from ..operators.flow import reshuffle
from ..plans.forecasts import forecast_series, forecasts, place_documents
from ..sources import files
from .registry import query, table


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_fields(spark, folder):
    texts = table(spark, folder, "events").select("event_id", "props")
    return files.parse_documents(texts, "props", "k bigint, absent string").drop("absent")


def _orders_with_city(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.struct(
            F.col("o_custkey").alias("id"),
            F.col("o_orderstatus").alias("name"),
            F.col("o_orderpriority").alias("country"),
            F.col("o_totalprice").alias("population"),
        ).alias("city"),
    )


@query("SELECT o_orderkey, o_orderstatus AS name, o_orderpriority AS country FROM orders")
def struct_drop_fields(spark, folder):
    pruned = conform.drop_inside(_orders_with_city(spark, folder), "city", "id", "population")
    return pruned.select("o_orderkey", "city.*")


@query(
    """
    SELECT o_orderkey, o_custkey AS id, o_orderstatus || o_custkey AS name,
           o_orderpriority AS country, o_totalprice AS population,
           o_totalprice / 2 AS lat, o_totalprice / 4 AS lon
    FROM orders
    """
)
def struct_with_field(spark, folder):
    name = F.concat("city.name", F.col("city.id").cast("string"))
    half = (F.col("city.population") / 2).alias("lat")
    coordinates = F.struct(half, (F.col("city.population") / 4).alias("lon"))
    placed = conform.set_inside(
        _orders_with_city(spark, folder), "city", {"name": name, "coordinates": coordinates}
    )
    return placed.select("o_orderkey", "city.*").select("*", "coordinates.*").drop("coordinates")


@query(
    """
    SELECT doc_id, list_filter(string_split(text, ' '), lambda w: w LIKE 'an%')[1] AS first_word
    FROM documents
    """
)
def array_first(spark, folder):
    words = F.filter(F.split("text", " "), lambda w: w.startswith("an"))
    return table(spark, folder, "documents").select(
        "doc_id", F.get(words, F.lit(0)).alias("first_word")
    )


@query(
    """
    SELECT conv_id, turn, unnest(string_split(text, ' ')) AS word
    FROM conversations WHERE text IS NOT NULL
    """
)
def explode_rows(spark, folder):
    turns = table(spark, folder, "conversations")
    return turns.select("conv_id", "turn", F.explode(F.split("text", " ")).alias("word"))


_STEPS = 3


def _documents(spark, folder):
    """Events as forecast documents of three steps, as JSON text with an airport code."""
    value, kind = F.col("value"), F.col("event_type")

    def step(k: int):
        at = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(3 * k))
        rain = F.when(kind == "signup", F.struct(F.lit(None).cast("double").alias("3h"))).when(
            kind != "view", F.struct((value / 100).alias("3h"))
        )
        weather = F.struct(
            F.lit(k).alias("id"),
            kind.alias("main"),
            F.concat(kind, F.lit(f" {k}")).alias("description"),
            F.lit("01d").alias("icon"),
        )
        none = F.array().cast("array<struct<id:int,main:string,description:string,icon:string>>")
        whole = F.floor(value).cast("int")
        return F.struct(
            F.struct(
                (value + k).alias("temp"),
                value.alias("feels_like"),
                (value - k).alias("temp_min"),
                (value + 2 * k).alias("temp_max"),
                (whole + 1000).alias("pressure"),
                (whole + 1001).alias("sea_level"),
                (whole + 900).alias("grnd_level"),
                (whole % 100).alias("humidity"),
                F.lit(0.5).alias("temp_kf"),
            ).alias("main"),
            F.when(kind == "error", none).otherwise(F.array(weather)).alias("weather"),
            F.struct((whole % 101).alias("all")).alias("clouds"),
            F.struct(
                (value / 10).alias("speed"),
                F.lit(10 * k).alias("deg"),
                F.when(kind == "click", value / 5).alias("gust"),
            ).alias("wind"),
            F.lit(10000).alias("visibility"),
            (value / 1000).alias("pop"),
            rain.alias("rain"),
            F.struct(F.lit("d" if k else "n").alias("pod")).alias("sys"),
            F.substring(at.cast("string"), 1, 19).alias("dt_txt"),
        )

    city = F.struct(
        F.col("event_id").alias("id"),
        F.lit("somewhere").alias("name"),
        F.lit("US").alias("country"),
        F.lit(7).alias("population"),
        F.lit(-3600).alias("timezone"),
        (F.col("event_id") + 1).alias("sunrise"),
        (F.col("event_id") + 2).alias("sunset"),
    )
    document = F.struct(
        F.lit("200").alias("cod"),
        F.lit(0).alias("message"),
        F.lit(_STEPS).alias("cnt"),
        city.alias("city"),
        F.array(*[step(k) for k in range(_STEPS)]).alias("list"),
    )
    # Writing and parsing JSON is the costly step here.
    events = reshuffle(table(spark, folder, "events"), "event_id")
    return events.select(
        F.col("user_id").cast("string").alias("airport_code"), F.to_json(document).alias("json")
    )


def _placed(spark, folder):
    """Documents with code and coordinates; a user without customer has none."""
    places = table(spark, folder, "customer").where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").cast("string").alias("airport_code"),
        F.struct(
            (F.col("c_acctbal") / 100).alias("lon"), F.col("c_nationkey").cast("double").alias("lat")
        ).alias("coordinates"),
    )
    documents = files.parse_documents(_documents(spark, folder), "json", C.FORECAST_DOCUMENT)
    return place_documents(documents, places)


_FORECASTS = """
    forecasts AS (
        SELECT CAST(user_id AS VARCHAR) AS airport_code,
               date_trunc('second', ts + to_hours(CAST(3 * k AS INTEGER))) AS datetime_recorded,
               value + k AS temperature, value AS feels_like, value - k AS temperature_min,
               value + 2 * k AS temperature_max, CAST(floor(value) AS INTEGER) + 1000 AS pressure,
               CAST(floor(value) AS INTEGER) + 1001 AS sea_level,
               CAST(floor(value) AS INTEGER) + 900 AS ground_level,
               CAST(floor(value) AS INTEGER) % 100 AS humidity,
               CASE WHEN event_type <> 'error' THEN event_type END AS weather_main,
               CASE WHEN event_type <> 'error' THEN event_type || ' ' || k END AS weather_description,
               CAST(floor(value) AS INTEGER) % 101 AS clouds_all, value / 10 AS wind_speed,
               CAST(10 * k AS INTEGER) AS wind_deg,
               CASE WHEN event_type = 'click' THEN value / 5 END AS wind_gust,
               10000 AS visibility, value / 1000 AS pop,
               CASE WHEN event_type IN ('signup', 'view') THEN 0 ELSE value / 100 END AS rain_3hr,
               CASE WHEN k > 0 THEN 'd' ELSE 'n' END AS pod, 'US' AS country, -3600 AS timezone,
               CAST(c_nationkey AS DOUBLE) AS latitude, c_acctbal / 100 AS longitude,
               event_id + 1 AS sunrise, event_id + 2 AS sunset
        FROM events CROSS JOIN unnest(generate_series(0, 2)) AS steps(k)
        LEFT JOIN (SELECT * FROM customer WHERE c_acctbal >= 0) ON user_id = c_custkey)
"""


@query(f"WITH {_FORECASTS} SELECT * FROM forecasts")
def flatten_forecast(spark, folder):
    return forecasts(_placed(spark, folder))


@query(f"WITH {_FORECASTS} SELECT airport_code, datetime_recorded, wind_speed FROM forecasts")
def forecast_variable(spark, folder):
    return forecast_series(forecasts(_placed(spark, folder)), None, "wind_speed")
