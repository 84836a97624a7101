"""Rasters as blocks and on other grids: events as sparse pixels, embeddings as dense tiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, regrid
from .registry import PIXELS, TILES, pixels, query, tiles

#: Metres per pixel of each band: finer than the new grid, coarser, and neither a multiple.
SCALES = {"click": 90, "error": 2000, "purchase": 11000, "signup": 10000, "view": 7000}
_SCALES = ", ".join(f"('{band}', {metres})" for band, metres in SCALES.items())


@query(
    f"""
    WITH {TILES}, steps AS (
        SELECT CAST(r AS INTEGER) AS r, CAST(c AS INTEGER) AS c
        FROM unnest(generate_series(-1, 1)) AS rs(r), unnest(generate_series(-1, 1)) AS cs(c))
    SELECT t.scene, t."row", t."col", CAST((r + 1) * 3 + c + 1 AS INTEGER) AS pos,
           CAST(coalesce(x.value, 0) AS FLOAT) AS value
    FROM tiles t CROSS JOIN steps LEFT JOIN tiles x
      ON x.scene = t.scene AND x."row" = t."row" + r AND x."col" = t."col" + c
    """
)
def patches_from_blocks(spark, folder):
    cells = tiles(spark, folder)
    stored = blocks.to_blocks(cells, side=4)
    found = blocks.patches_from_blocks(stored, cells, 3, side=4)
    return found.select("scene", "row", "col", F.posexplode("patch").alias("pos", "value"))


@query(
    f"""
    WITH {PIXELS}
    SELECT band, "row", "col", max(value) AS value FROM pixels WHERE value IS NOT NULL GROUP BY ALL
    """
)
def blocks_to_pixels(spark, folder):
    stored = blocks.to_blocks(pixels(spark, folder), ("band",), side=4)
    return blocks.to_pixels(stored, ("band",), side=4)


@query(
    f"""
    WITH {PIXELS}, scales(band, metres) AS (VALUES {_SCALES}), cells AS (
        SELECT unnest(generate_series(0, 100000)) AS cell)
    SELECT scene_ts, CAST(r.cell AS INTEGER) AS "row", CAST(c.cell AS INTEGER) AS "col", band, value
    FROM pixels JOIN scales USING (band)
    JOIN cells r ON r.cell * 20000 + 10000 >= 2 * metres * "row" AND r.cell * 20000 + 10000 < 2 * metres * ("row" + 1)
    JOIN cells c ON c.cell * 20000 + 10000 >= 2 * metres * "col" AND c.cell * 20000 + 10000 < 2 * metres * ("col" + 1)
    """
)
def regrid_nearest(spark, folder):
    return regrid.nearest(pixels(spark, folder), SCALES)


@query(
    f"""
    WITH {PIXELS}, scales(band, metres) AS (VALUES {_SCALES}), edges AS (
        SELECT band, CAST(value AS DECIMAL(12, 2)) AS value, metres, "row" * metres AS top, "col" * metres AS "left"
        FROM pixels JOIN scales USING (band) WHERE value IS NOT NULL),
    rows AS (
        SELECT *, unnest(generate_series(top // 10000, (top + metres - 1) // 10000)) AS r FROM edges),
    cells AS (
        SELECT *, unnest(generate_series("left" // 10000, ("left" + metres - 1) // 10000)) AS c FROM rows),
    shares AS (
        SELECT band, value, r, c,
               (least(top + metres, (r + 1) * 10000) - greatest(top, r * 10000))
               * (least("left" + metres, (c + 1) * 10000) - greatest("left", c * 10000)) AS area
        FROM cells)
    SELECT CAST(r AS INTEGER) AS "row", CAST(c AS INTEGER) AS "col", band,
           CAST(sum(value * CAST(area AS DECIMAL(18, 0))) AS DOUBLE) / CAST(sum(area) AS DOUBLE) AS value,
           CAST(sum(area) AS BIGINT) AS area
    FROM shares GROUP BY ALL
    """
)
def regrid_mean(spark, folder):
    exact = pixels(spark, folder).withColumn("value", F.col("value").cast("decimal(12,2)"))
    return regrid.mean(exact, SCALES)


@query(
    f"""
    WITH {PIXELS}, levels AS (SELECT CAST(unnest(range(4)) AS INTEGER) AS level)
    SELECT level, CAST("row" // (1 << level) AS INTEGER) AS "row", CAST("col" // (1 << level) AS INTEGER) AS "col",
           band, CAST(sum(CAST(value AS DECIMAL(12, 2))) AS DOUBLE) AS total, count(*) AS pixels
    FROM pixels, levels WHERE value IS NOT NULL GROUP BY ALL
    """
)
def overview_pyramid(spark, folder):
    exact = pixels(spark, folder).withColumn("value", F.col("value").cast("decimal(12,2)"))
    return regrid.pyramid(exact, 3).withColumn("total", F.col("total").cast("double"))
