"""Training set: random dates, one point per stratum, patches, batches of examples."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.geo import in_region
from ..functions.times import ntz, shift_hours
from ..functions.hashing import seeded_hash
from ..operators.joins import enrich
from ..operators.numbering import with_batch
from ..operators.patches import patch_cells
from ..operators.quality import split_rejects
from ..operators.raster import mosaics_at, one_cell_per_stratum, strata, values_at
from ..operators.sampling import random_dates
from ..session import durable

POINT = ["at", "row", "col"]


def draw_dates(
    spark: SparkSession,
    start: dt.datetime,
    end: dt.datetime,
    num_dates: int = C.NUM_DATES,
    seed: int = 0,
) -> list[dt.datetime]:
    """``num_dates`` even random moments in [start, end)."""
    drawn = random_dates(spark.range(num_dates), ["id"], start, end, seed)
    return [row["at"] for row in drawn.select("at").orderBy("id").collect()]


def scenes_for(
    pixels: DataFrame,
    dates: Sequence[dt.datetime],
    first_hour: int = -C.LOOKBACK_HOURS,
    last_hour: int = 0,
    day_column: str | None = None,
) -> DataFrame:
    """Pixels that any date looks at, from its first to before its last hour.

    Spans that meet are merged, and the scan gets one range for each that is left: between
    dates far apart nothing is read but the row groups their ranges touch. With a table
    partitioned by day, name that column and only its folders are read.
    """
    if not dates:
        raise ValueError("no dates")
    spans: list[list[dt.datetime]] = []
    for date in sorted(dates):
        first, after = (date + dt.timedelta(hours=h) for h in (first_hour, last_hour))
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], after)
        else:
            spans.append([first, after])
    if day_column is not None:
        days = set()
        for first, after in spans:
            days |= {first.date() + dt.timedelta(days=n) for n in range((after.date() - first.date()).days + 1)}
        pixels = pixels.where(F.col(day_column).isin(sorted(days)))
    ts = F.col("scene_ts")
    ranges = [(ts >= ntz(first)) & (ts < ntz(after)) for first, after in spans]
    return pixels.where(reduce(lambda a, b: a | b, ranges))


def sample_points(
    pixels: DataFrame,
    grid: DataFrame,
    dates: Sequence[dt.datetime],
    num_bins: int = C.NUM_BINS,
    region: Sequence[tuple[float, float]] | None = C.REGION,
    seed: int = 0,
    day_column: str | None = None,
) -> DataFrame:
    """(at, stratum, row, col): one cell per date and stratum, with lon and lat if ``grid`` has them.

    ``grid`` is (row, col, elevation), with lon and lat where a region is given.
    """
    inside = grid if region is None else grid.where(in_region("lon", "lat", region))
    moments = pixels.sparkSession.createDataFrame([(d,) for d in dates], "at timestamp_ntz")
    rain = scenes_for(pixels, dates, day_column=day_column).where(
        F.col("band") == C.PRECIPITATION_BAND
    )
    mosaics = mosaics_at(rain, moments, unique_times=False).drop("band")
    points = one_cell_per_stratum(strata(mosaics, inside, dates, num_bins), seed=seed)
    if not {"lon", "lat"} <= set(grid.columns):
        return points
    return enrich(points, grid.select("row", "col", "lon", "lat"), ["row", "col"], hot_rows=None)


def channels(imager_bands: Sequence[str]) -> list[tuple[str, int, str, int]]:
    """(part, channel, band, hours) of every image channel, in array order.

    Inputs are the precipitation sequence, then the imager sequence; elevation
    follows as the last input channel. Labels are the precipitation to come.
    """
    inputs = [(C.PRECIPITATION_BAND, h) for h in C.INPUT_HOURS]
    inputs += [(band, h) for h in C.INPUT_HOURS for band in imager_bands]
    labels = [(C.PRECIPITATION_BAND, h) for h in C.LABEL_HOURS]
    return [("inputs", i, b, h) for i, (b, h) in enumerate(inputs)] + [
        ("labels", i, b, h) for i, (b, h) in enumerate(labels)
    ]


def training_examples(
    pixels: DataFrame,
    grid: DataFrame,
    points: DataFrame,
    imager_bands: Sequence[str],
    patch_size: int = C.PATCH_SIZE,
    pick: str = "earliest",
) -> DataFrame:
    """(at, row, col, inputs, labels) per distinct point (at, row, col).

    Both arrays are flat, in row, col, channel order; masked pixels and those off
    the grid are 0.
    """
    images = channels(imager_bands)
    height_channel = sum(1 for part, *_ in images if part == "inputs")
    centres = points.select(
        F.col("at").alias("point_at"),
        "row",
        "col",
        F.col("row").alias("centre_row"),
        F.col("col").alias("centre_col"),
    ).distinct()
    cells = patch_cells(centres, patch_size)
    centre = ["point_at", "centre_row", "centre_col"]
    wanted = F.array(
        *[
            F.struct(
                F.lit(part).alias("part"),
                F.lit(channel).alias("channel"),
                F.lit(band).alias("band"),
                F.lit(hours).alias("hours"),
            )
            for part, channel, band, hours in images
        ]
    )
    probes = cells.withColumn("_w", F.explode(wanted)).select(
        *centre,
        "pos",
        "row",
        "col",
        "_w.part",
        "_w.channel",
        "_w.band",
        shift_hours("point_at", F.col("_w.hours")).alias("at"),
    )
    key = [*centre, "part", "pos", "channel"]
    seen = values_at(pixels, probes, key, pick=pick)
    ground = grid.select("row", "col", F.col("elevation").cast("double").alias("value"))
    heights = enrich(cells, ground, ["row", "col"], hot_rows=None).select(
        *centre,
        F.lit("inputs").alias("part"),
        "pos",
        F.lit(height_channel).alias("channel"),
        "value",
    )
    value = F.coalesce("value", F.lit(0.0)).cast("float").alias("value")
    # A point has size² × channels values, so its lists have a fixed length.
    parts = seen.unionByName(heights).select(*key, value).groupBy(*centre)

    def array_of(part: str):
        entry = F.when(F.col("part") == part, F.struct("pos", "channel", "value"))
        return F.col(f"_{part}.value").alias(part), F.array_sort(
            F.collect_list(entry)
        ).alias(f"_{part}")

    picks, lists = zip(*[array_of("inputs"), array_of("labels")])
    return parts.agg(*lists).select(
        F.col("point_at").alias("at"),
        F.col("centre_row").alias("row"),
        F.col("centre_col").alias("col"),
        *picks,
    )


def training_batches(
    pixels: DataFrame,
    grid: DataFrame,
    dates: Sequence[dt.datetime],
    imager_bands: Sequence[str],
    num_bins: int = C.NUM_BINS,
    patch_size: int = C.PATCH_SIZE,
    min_batch_size: int = C.MIN_BATCH_SIZE,
    region: Sequence[tuple[float, float]] | None = C.REGION,
    seed: int = 0,
    day_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Examples with ``batch_id`` and ``example_no``, and the points left out.

    The points are written once before the costly patch step: they are few, and
    every later stage starts from them. Points whose time or cell is unknown are
    left out, with a reason.
    """
    drawn = durable(
        sample_points(pixels, grid, dates, num_bins, region, seed, day_column)
    )
    points, rejected = split_rejects(
        drawn,
        {"time": F.col("at").isNull(), "cell": F.col("row").isNull() | F.col("col").isNull()},
    )
    needed = scenes_for(
        pixels,
        dates,
        min(C.INPUT_HOURS) - C.LOOKBACK_HOURS,
        max(C.LABEL_HOURS),
        day_column,
    ).where(F.col("band").isin([C.PRECIPITATION_BAND, *imager_bands]))
    examples = training_examples(needed, grid, points, imager_bands, patch_size)
    # Numbers come from the points, which are narrow; their patches are made once.
    mixed = points.select(*POINT).distinct().withColumn("example_no", seeded_hash(seed, *POINT))
    batch = with_batch(mixed, ["example_no", *POINT], min_batch_size)
    return enrich(examples, batch, list(POINT), "inner", hot_rows=None), rejected
