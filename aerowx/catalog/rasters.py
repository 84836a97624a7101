"""Raster operators on events as sparse pixels and embeddings as dense tiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import contracts as C
from ..operators import patches, raster
from ..plans import maps
from ..plans.training import sample_points, training_batches, training_examples
from ..session import durable
from .registry import PIXELS, TILES, pixels, query, table, tiles

BANDS = ["click", "error", "purchase", "signup", "view"]
AT = dt.datetime(2024, 1, 10, 18, 0)
_AT = "TIMESTAMP '2024-01-10 18:00:00'"


@query(
    f"""
    WITH {PIXELS}
    SELECT * FROM pixels WHERE scene_ts >= {_AT} - INTERVAL 1 DAY AND scene_ts < {_AT}
    """
)
def scene_window(spark, folder):
    return raster.scene_window(pixels(spark, folder), AT)


@query(f"WITH {PIXELS} SELECT * FROM pixels WHERE regexp_full_match(band, 's.*|view')")
def band_regex(spark, folder):
    return raster.bands_like(pixels(spark, folder), "s.*|view")


def _mosaic_sql(choose: str) -> str:
    return f"""
    WITH {PIXELS}
    SELECT "row", "col", band, {choose}(value, scene_ts) AS value
    FROM pixels WHERE value IS NOT NULL GROUP BY ALL
    """


@query(_mosaic_sql("arg_min"))
def mosaic(spark, folder):
    return raster.mosaic(pixels(spark, folder))


@query(_mosaic_sql("arg_max"))
def mosaic_latest(spark, folder):
    return raster.mosaic(pixels(spark, folder), pick="latest", unique_times=True)


@query(
    f"""
    WITH {PIXELS}, dates AS (
        SELECT DISTINCT date_trunc('day', scene_ts) + INTERVAL 6 HOUR AS "at" FROM pixels)
    SELECT "at", "row", "col", band, arg_min(value, scene_ts) AS value
    FROM pixels JOIN dates ON scene_ts >= "at" - INTERVAL 1 DAY AND scene_ts < "at"
    WHERE value IS NOT NULL GROUP BY ALL
    """
)
def mosaics_by_date(spark, folder):
    scenes = pixels(spark, folder)
    day = F.col("scene_ts").cast("date").cast("timestamp_ntz")
    dates = scenes.select((day + F.expr("INTERVAL 6 HOURS")).alias("at")).distinct()
    found = raster.mosaics_at(scenes, dates)
    return found.select("at", "row", "col", "band", "value")


_DAILY = f"""
    {PIXELS}, daily AS (
        SELECT "row", "col", band, datediff('day', DATE '2024-01-01', CAST(scene_ts AS DATE)) % 3 AS i,
               arg_min(value, scene_ts) AS value
        FROM pixels WHERE value IS NOT NULL GROUP BY ALL)
"""


def _sequence(spark, folder):
    """Three images, of every third day each."""
    day = F.datediff(F.to_date("scene_ts"), F.lit("2024-01-01")) % 3
    scenes = pixels(spark, folder).withColumn("i", day)
    return raster.mosaic(scenes, ("row", "col", "band", "i"))


def _bands_sql() -> str:
    columns = ", ".join(
        f"max(CASE WHEN i = {i} AND band = '{b}' THEN value END) AS \"{i}_{b}\""
        for i in range(3)
        for b in BANDS
    )
    return f'WITH {_DAILY} SELECT "row", "col", {columns} FROM daily GROUP BY "row", "col"'


@query(_bands_sql())
def to_bands(spark, folder):
    return raster.to_bands(_sequence(spark, folder), "i", 3, BANDS)


@query(
    f"""
    WITH {PIXELS}
    SELECT "row", "col", 'elevation' AS band, max(value) AS value FROM pixels GROUP BY ALL
    UNION ALL
    SELECT "row", "col", band, arg_min(value, scene_ts) FROM pixels WHERE value IS NOT NULL GROUP BY ALL
    """
)
def band_stack(spark, folder):
    scenes = pixels(spark, folder)
    height = scenes.groupBy("row", "col").agg(F.max("value").alias("value"))
    return raster.stack_bands(
        [
            raster.rename_band(height, "elevation").select("row", "col", "band", "value"),
            raster.mosaic(scenes),
        ]
    )


@query(
    f"""
    WITH {PIXELS} SELECT scene_ts, "row", "col", band, CASE WHEN value > 50 THEN value END AS value
    FROM pixels
    """
)
def threshold_mask(spark, folder):
    return raster.mask_at_most(pixels(spark, folder), 50.0)


@query(
    f"""
    WITH {PIXELS}, image AS (
        SELECT "row", "col", band, arg_min(value, scene_ts) AS value FROM pixels
        WHERE value IS NOT NULL AND scene_ts >= {_AT} - INTERVAL 1 DAY AND scene_ts < {_AT} GROUP BY ALL),
    grid AS (SELECT DISTINCT "row", "col" FROM pixels),
    bands AS (SELECT unnest(['click', 'error', 'purchase', 'signup', 'view', 'none']) AS band)
    SELECT g."row", g."col", b.band, coalesce(i.value, 0) AS value
    FROM grid g CROSS JOIN bands b LEFT JOIN image i
      ON i."row" = g."row" AND i."col" = g."col" AND i.band = b.band
    """
)
def unmask_fill(spark, folder):
    scenes = pixels(spark, folder)
    image = raster.mosaic(raster.scene_window(scenes, AT))
    grid = scenes.select("row", "col").distinct()
    return raster.fill_masked(image, grid, [*BANDS, "none"])


@query(
    f"""
    WITH {PIXELS}, classed AS (
        SELECT scene_ts, "row", "col", band, value,
               CASE WHEN value IS NOT NULL
                    THEN CAST(least(greatest(floor(value / 20 * 10), 0), 9) AS INTEGER) END AS class
        FROM pixels)
    SELECT * REPLACE (coalesce(class, -1) AS class), ['000096', '0064ff', '00b4ff', '33db80', '9beb4a', 'ffeb00', 'ffb300', 'ff6400',
               'eb1e00', 'af0000'][class + 1] AS colour FROM classed
    """
)
def class_breaks(spark, folder):
    classed = raster.colour_classes(
        pixels(spark, folder), C.PRECIPITATION_PALETTE, C.PRECIPITATION_STRETCH
    )
    return classed.withColumn("class", F.coalesce("class", F.lit(-1)))


@query(
    """
    SELECT c_custkey, CAST(floor((80 - lat) / 0.5) AS INTEGER) AS "row",
           CAST(floor((lon + 230) / 0.5) AS INTEGER) AS "col"
    FROM (SELECT c_custkey, c_acctbal / 25 - 180 AS lon, c_nationkey * 6.0 - 71.5 AS lat FROM customer)
    """
)
def point_to_cell(spark, folder):
    lon = F.col("c_acctbal") / 25 - 180
    lat = F.col("c_nationkey") * F.lit(6.0) - F.lit(71.5)
    cells = raster.cell_columns(lon, lat, west=-230.0, north=80.0, size=0.5)
    return table(spark, folder, "customer").select(
        "c_custkey", *[c.alias(n) for n, c in cells.items()]
    )


_HOURS = {"in_4": -4, "in_2": -2, "in_0": 0, "out_2": 2, "out_6": 6}


def _lagged_sql(choose: str) -> str:
    columns = ", ".join(
        f"max(CASE WHEN name = '{n}' THEN value END) AS {n}" for n in _HOURS
    )
    hours = ", ".join(f"('{n}', {h})" for n, h in _HOURS.items())
    return f"""
    WITH {PIXELS}, points AS (SELECT DISTINCT scene_ts AS "at", "row", "col" FROM pixels),
    hours(name, h) AS (VALUES {hours}),
    seen AS (
        SELECT p."at", p."row", p."col", h.name, {choose}(x.value, x.scene_ts) AS value
        FROM points p CROSS JOIN hours h LEFT JOIN pixels x
          ON x."row" = p."row" AND x."col" = p."col" AND x.band = 'purchase' AND x.value IS NOT NULL
         AND x.scene_ts >= p."at" + to_hours(h.h - 24) AND x.scene_ts < p."at" + to_hours(h.h)
        GROUP BY ALL),
    wide AS (SELECT "at", "row", "col", {columns} FROM seen GROUP BY "at", "row", "col")
    SELECT "at", "row", "col", {", ".join(f"coalesce({n}, 0) AS {n}" for n in _HOURS)} FROM wide
    """


def _points(scenes):
    return scenes.select(F.col("scene_ts").alias("at"), "row", "col")


@query(_lagged_sql("arg_min"))
def lagged_features(spark, folder):
    scenes = pixels(spark, folder)
    return raster.lagged_features(scenes, _points(scenes), _HOURS, "purchase")


@query(_lagged_sql("arg_min"))
def lagged_by_bitmap(spark, folder):
    """The same with the wanted cells as bitmaps, as where they are too many to broadcast."""
    scenes = pixels(spark, folder)
    return raster.lagged_features(scenes, _points(scenes), _HOURS, "purchase", max_rows=0)


@query(_lagged_sql("arg_max"))
def lagged_latest(spark, folder):
    scenes = pixels(spark, folder)
    return raster.lagged_features(
        scenes, _points(scenes), _HOURS, "purchase", pick="latest", slices_per_day=4, max_rows=0
    )


def _flat(patch):
    whole = F.transform(patch, lambda v: F.floor(v.cast("double") * 1000000).cast("string"))
    return F.array_join(whole, ",")


@query(
    f"""
    WITH {TILES}, steps AS (
        SELECT CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c
        FROM unnest(generate_series(-2, 2)) AS rs(r), unnest(generate_series(-2, 2)) AS cs(c))
    SELECT t.scene, t."row", t."col",
           string_agg(CAST(CAST(floor(CAST(coalesce(x.value, 0) AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR),
                      ',' ORDER BY r, c) AS patch
    FROM tiles t CROSS JOIN steps LEFT JOIN tiles x
      ON x.scene = t.scene AND x."row" = t."row" + r AND x."col" = t."col" + c
    GROUP BY ALL
    """
)
def patch_extract(spark, folder):
    cells = tiles(spark, folder)
    found = patches.extract_patches(cells, cells, C.PATCH_SIZE)
    return found.withColumn("patch", _flat("patch"))


def _draw(*keys: str) -> str:
    text = " || '|' || ".join(["'0'", *keys])
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


_DATES = [dt.datetime(2024, 1, d, 12, 0) for d in (4, 9, 14, 19, 24)]
_MOMENT = """strftime("at", '%Y-%m-%d %H:%M:%S')"""

_STRATA = f"""
    {PIXELS}, dates AS (
        SELECT unnest(generate_series(TIMESTAMP '2024-01-04 12:00:00',
                                      TIMESTAMP '2024-01-24 12:00:00', INTERVAL 5 DAY)) AS "at"),
    grid AS (SELECT "row", "col", max(value) * 12 AS elevation FROM pixels GROUP BY ALL),
    rain AS (
        SELECT d."at", x."row", x."col", arg_min(x.value, x.scene_ts) AS value
        FROM dates d JOIN pixels x ON x.scene_ts >= d."at" - INTERVAL 1 DAY AND x.scene_ts < d."at"
        WHERE x.band = 'view' AND x.value IS NOT NULL GROUP BY ALL),
    strata AS (
        SELECT d."at", g."row", g."col",
               CAST(floor(least(greatest(coalesce(r.value, 0), 0), 30) / 30 * 9) AS INTEGER) AS precipitation_bin,
               CAST(floor(least(greatest(coalesce(g.elevation, 0), 0), 6000) / 6000 * 9) AS INTEGER) AS elevation_bin
        FROM grid g CROSS JOIN dates d LEFT JOIN rain r
          ON r."at" = d."at" AND r."row" = g."row" AND r."col" = g."col"),
    chosen AS (
        SELECT *, elevation_bin * 10 + precipitation_bin AS stratum FROM strata),
    points AS (
        SELECT "at", stratum, "row", "col" FROM (
            SELECT *, row_number() OVER (PARTITION BY "at", stratum
                ORDER BY {_draw(_MOMENT, 'CAST("row" AS VARCHAR)', 'CAST("col" AS VARCHAR)')}) AS rn
            FROM chosen) WHERE rn = 1)
"""


def _grid(scenes):
    return scenes.groupBy("row", "col").agg((F.max("value") * 12).alias("elevation"))


def _strata(spark, folder):
    scenes = pixels(spark, folder)
    dates = spark.createDataFrame([(d,) for d in _DATES], "at timestamp_ntz")
    rain = raster.mosaics_at(scenes.where(F.col("band") == "view"), dates).drop("band")
    return raster.strata(rain, _grid(scenes), _DATES)


@query(f"WITH {_STRATA} SELECT * FROM chosen")
def strata_grid(spark, folder):
    return _strata(spark, folder)


@query(f"WITH {_STRATA} SELECT * FROM points")
def stratum_points(spark, folder):
    return raster.one_cell_per_stratum(_strata(spark, folder))


_RING = [(-120.0, -20.0), (-40.0, -50.0), (-60.0, 40.0), (-115.0, 45.0)]
_CROSSED = " + ".join(
    f"CAST(((({y1}) > lat) != (({y2}) > lat)) AND lon < ({(x2 - x1) / (y2 - y1)!r}) * (lat - ({y1})) + ({x1}) AS INTEGER)"
    for (x1, y1), (x2, y2) in zip(_RING, [*_RING[1:], _RING[0]])
)
_INSIDE = f"""max(value) * 12 AS elevation, "row" * CAST(1 AS DOUBLE) - 130 AS lon,
               "col" * CAST(11 AS DOUBLE) - 55 AS lat
        FROM pixels GROUP BY "row", "col" HAVING ({_CROSSED}) % 2 = 1),"""


@query(
    f"""
    WITH {_STRATA.replace("max(value) * 12 AS elevation FROM pixels GROUP BY ALL),", _INSIDE)}
    SELECT "at", stratum, "row", "col", lon, lat FROM points JOIN grid USING ("row", "col")
    """
)
def training_points(spark, folder):
    """Points of every stratum inside a region, with their coordinates."""
    scenes = _rain_scenes(spark, folder)
    lon, lat = F.col("row") * F.lit(1.0) - 130, F.col("col") * F.lit(11.0) - 55
    grid = _grid(scenes).select("*", lon.alias("lon"), lat.alias("lat"))
    return sample_points(scenes, grid, _DATES, region=_RING)


_IMAGER = ["click", "error"]


def _examples_cte() -> str:
    rows = [("inputs", i, "view", h) for i, h in enumerate(C.INPUT_HOURS)]
    rows += [
        ("inputs", 3 + 2 * i + j, band, h)
        for i, h in enumerate(C.INPUT_HOURS)
        for j, band in enumerate(_IMAGER)
    ]
    rows += [("labels", i, "view", h) for i, h in enumerate(C.LABEL_HOURS)]
    listed = ", ".join(f"('{p}', {c}, '{b}', {h})" for p, c, b, h in rows)
    number = "CAST(CAST(floor(CAST(CAST(value AS FLOAT) AS DOUBLE) * 1000) AS BIGINT) AS VARCHAR)"
    return f"""
    {_STRATA}, channels(part, channel, band, h) AS (VALUES {listed}),
    steps AS (
        SELECT CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c
        FROM unnest(generate_series(-1, 1)) AS rs(r), unnest(generate_series(-1, 1)) AS cs(c)),
    places AS (SELECT DISTINCT "at", "row", "col" FROM points),
    seen AS (
        SELECT p."at", p."row", p."col", n.part, n.channel, r, c,
               coalesce(arg_min(x.value, x.scene_ts), 0) AS value
        FROM places p CROSS JOIN steps CROSS JOIN channels n LEFT JOIN pixels x
          ON x."row" = p."row" + r AND x."col" = p."col" + c AND x.band = n.band
         AND x.value IS NOT NULL
         AND x.scene_ts >= p."at" + to_hours(n.h - 24) AND x.scene_ts < p."at" + to_hours(n.h)
        GROUP BY ALL
        UNION ALL
        SELECT p."at", p."row", p."col", 'inputs', 9, r, c, coalesce(g.elevation, 0)
        FROM places p CROSS JOIN steps LEFT JOIN grid g
          ON g."row" = p."row" + r AND g."col" = p."col" + c),
    examples AS (
        SELECT "at", "row", "col",
               string_agg({number}, ',' ORDER BY r, c, channel) FILTER (WHERE part = 'inputs') AS inputs,
               string_agg({number}, ',' ORDER BY r, c, channel) FILTER (WHERE part = 'labels') AS labels
        FROM seen GROUP BY ALL)
    """


def _rain_scenes(spark, folder):
    """The stand-in pixels with 'view' as the rain band."""
    band = F.when(F.col("band") == "view", C.PRECIPITATION_BAND).otherwise(F.col("band"))
    return pixels(spark, folder).withColumn("band", band)


def _text(name):
    whole = F.transform(name, lambda v: F.floor(v.cast("double") * 1000).cast("string"))
    return F.array_join(whole, ",").alias(name)


@query(f"WITH {_examples_cte()} SELECT * FROM examples")
def training_patches(spark, folder):
    scenes = _rain_scenes(spark, folder)
    points = durable(raster.one_cell_per_stratum(_strata(spark, folder)))
    examples = training_examples(scenes, _grid(scenes), points, _IMAGER, patch_size=3)
    return examples.select("at", "row", "col", _text("inputs"), _text("labels"))


@query(
    f"""
    WITH {_examples_cte()}, numbered AS (
        SELECT *, row_number() OVER (ORDER BY
                   {_draw(_MOMENT, 'CAST("row" AS VARCHAR)', 'CAST("col" AS VARCHAR)')}) - 1 AS n,
               count(*) OVER () AS total
        FROM examples)
    SELECT "at", "row", "col", inputs, labels,
           least(n // 20, greatest(total // 20 - 1, 0)) AS batch_id
    FROM numbered
    """
)
def training_set(spark, folder):
    """The whole way: points, patches, labels and batches."""
    scenes = _rain_scenes(spark, folder)
    examples, _ = training_batches(
        scenes, _grid(scenes), _DATES, _IMAGER, patch_size=3, region=None
    )
    return examples.select("at", "row", "col", _text("inputs"), _text("labels"), "batch_id")


def _named(spark, folder):
    """The stand-in pixels under the band names that the map layers read."""
    names = {"view": C.PRECIPITATION_BAND, "click": "CMI_C01", "error": "CMI_C02", "signup": "CMI_C03"}
    by_name = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    scenes = pixels(spark, folder)
    return scenes.withColumn("band", F.coalesce(by_name[F.col("band")], F.col("band")))


_SEEN = f"""
    {PIXELS}, seen AS (
        SELECT "row", "col", band, arg_min(value, scene_ts) AS value FROM pixels
        WHERE value IS NOT NULL AND scene_ts >= {_AT} - INTERVAL 1 DAY AND scene_ts < {_AT} GROUP BY ALL)
"""


@query(
    f"""
    WITH {_SEEN}, shown AS (
        SELECT *, CAST(least(greatest(floor(value / 20 * 10), 0), 9) AS INTEGER) AS class
        FROM seen WHERE band = 'view' AND value > 0.1)
    SELECT "row", "col", 'precipitationCal' AS band, value, class,
           ['000096', '0064ff', '00b4ff', '33db80', '9beb4a', 'ffeb00', 'ffb300', 'ff6400',
            'eb1e00', 'af0000'][class + 1] AS colour FROM shown
    """
)
def map_precipitation(spark, folder):
    return maps.precipitation_layer(_named(spark, folder), AT)


def _stretched(band: str) -> str:
    value = f"coalesce(max(CASE WHEN band = '{band}' THEN value END), 0)"
    return f"CAST(least(greatest(floor({value} / 3000 * 256), 0), 255) AS INTEGER)"


@query(
    f"""
    WITH {_SEEN}, grid AS (SELECT DISTINCT "row", "col" FROM pixels)
    SELECT "row", "col", {_stretched("error")} AS red, {_stretched("signup")} AS green,
           {_stretched("click")} AS blue
    FROM grid LEFT JOIN seen USING ("row", "col") GROUP BY ALL
    """
)
def map_imager(spark, folder):
    scenes = _named(spark, folder)
    return maps.imager_layer(scenes, AT, scenes.select("row", "col").distinct())


@query(
    f"""
    WITH {PIXELS}, grid AS (SELECT "row", "col", max(value) * 12 AS value FROM pixels GROUP BY ALL),
    classed AS (
        SELECT *, CAST(least(greatest(floor(value / 3000 * 8), 0), 7) AS INTEGER) AS class FROM grid)
    SELECT *, ['000000', '478FCD', '86C58E', 'AFC35E', '8F7131', 'B78D4F', 'E2B8A6', 'FFFFFF'][class + 1]
           AS colour FROM classed
    """
)
def map_elevation(spark, folder):
    return maps.elevation_layer(_grid(pixels(spark, folder)))
