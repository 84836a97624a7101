"""Map layers as pixel tables: what a map draws, with class and colour per cell."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.numbers import class_of
from ..operators.raster import (
    CELL,
    colour_classes,
    fill_masked,
    mask_at_most,
    mosaic,
    scene_window,
    to_bands,
)

# Red, green and blue of the imager picture, and its stretch (fixed values).
IMAGER_COLOURS = ("CMI_C02", "CMI_C03", "CMI_C01")
IMAGER_STRETCH = (0.0, 3000.0)


def precipitation_layer(pixels: DataFrame, at: dt.datetime) -> DataFrame:
    """Rain at a moment in ten colours; cells without rain to show are left out."""
    rain = mosaic(scene_window(pixels, at, bands=[C.PRECIPITATION_BAND]))
    shown = mask_at_most(rain).where(F.col("value").isNotNull())
    return colour_classes(shown, C.PRECIPITATION_PALETTE, C.PRECIPITATION_STRETCH)


def imager_layer(pixels: DataFrame, at: dt.datetime, grid: DataFrame) -> DataFrame:
    """(row, col, red, green, blue), each 0..255, for every grid cell."""
    image = mosaic(scene_window(pixels, at, bands=IMAGER_COLOURS))
    filled = fill_masked(image, grid, IMAGER_COLOURS).withColumn("i", F.lit(0))
    wide = to_bands(filled, "i", 1, IMAGER_COLOURS)
    return wide.select(
        *CELL,
        *[
            class_of(f"0_{band}", *IMAGER_STRETCH, 256).alias(name)
            for band, name in zip(IMAGER_COLOURS, ("red", "green", "blue"))
        ],
    )


def elevation_layer(grid: DataFrame) -> DataFrame:
    """Elevation in eight colours."""
    heights = grid.select(*CELL, F.col("elevation").cast("double").alias("value"))
    return colour_classes(heights, C.ELEVATION_PALETTE, C.ELEVATION_STRETCH)


def layer_moments(at: dt.datetime, hours: tuple[int, ...]) -> list[dt.datetime]:
    """The moments whose layers a map shows: those of the inputs or of the labels."""
    return [at + dt.timedelta(hours=h) for h in hours]
