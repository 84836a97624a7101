"""Square patches of pixels round points, as flat row-major arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import BROADCAST_BYTES, BROADCAST_ROWS, fits_broadcast

STRIP = 16


def offsets(size: int) -> list[tuple[int, int]]:
    """(row, col) steps from the centre, row by row. An even size reaches one step
    further up and left."""
    steps = range(-(size // 2), size - size // 2)
    return [(r, c) for r in steps for c in steps]


def patch_cells(points: DataFrame, size: int) -> DataFrame:
    """One row per point and patch cell: ``pos`` 0..size²-1, row and col moved to the cell."""
    steps = F.array(
        *[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in offsets(size)]
    )
    kept = [c for c in points.columns if c not in ("row", "col")]
    return points.select("*", F.posexplode(steps).alias("pos", "_step")).select(
        *kept,
        "pos",
        (F.col("row") + F.col("_step.r")).alias("row"),
        (F.col("col") + F.col("_step.c")).alias("col"),
    )


def extract_patches(
    pixels: DataFrame,
    centres: DataFrame,
    size: int,
    scene: Sequence[str] = ("scene",),
    fill: float = 0.0,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The size×size patch of ``pixels`` (scene, row, col, value) round each centre.

    Columns (scene, row, col, patch): missing pixels and cells over the edge get
    ``fill``; a cell given twice counts with its larger value. Centres are made
    distinct. If they are few, their cells are broadcast and the pixels stay where
    they are; otherwise both meet by strips of a row.
    """
    places = centres.select(*scene, "row", "col").distinct()
    count = size * size
    if fits_broadcast(places, max_rows // count, max_bytes // count):
        return _by_cell(pixels, places, size, list(scene), fill)
    return _by_strip(pixels, places, size, list(scene), fill)


def _by_cell(
    pixels: DataFrame, places: DataFrame, size: int, scene: list[str], fill: float
) -> DataFrame:
    count = size * size
    asked = patch_cells(
        places.withColumns({"centre_row": F.col("row"), "centre_col": F.col("col")}), size
    )
    centre = [*scene, "centre_row", "centre_col"]
    hits = pixels.join(F.broadcast(asked), [*scene, "row", "col"]).select(*centre, "pos", "value")
    # A centre without any pixel still gives a patch.
    bare = places.select(
        *scene,
        F.col("row").alias("centre_row"),
        F.col("col").alias("centre_col"),
        F.lit(None).cast("int").alias("pos"),
        F.lit(None).cast(dict(pixels.dtypes)["value"]).alias("value"),
    )
    slots = [F.max(F.when(F.col("pos") == i, F.col("value"))).alias(f"_v{i}") for i in range(count)]
    filled = [F.coalesce(F.col(f"_v{i}"), F.lit(fill)).cast("float") for i in range(count)]
    return (
        hits.union(bare)
        .groupBy(*centre)
        .agg(*slots)
        .select(
            *scene,
            F.col("centre_row").alias("row"),
            F.col("centre_col").alias("col"),
            F.array(*filled).alias("patch"),
        )
    )


def _by_strip(
    pixels: DataFrame, places: DataFrame, size: int, scene: list[str], fill: float
) -> DataFrame:
    """Gather pixels into strips of one row, and let each centre read its ``size`` strips.

    A strip holds STRIP cells and those that patches reach beside them, so a pixel
    goes to one strip mostly, and many pixels shuffle as one row.
    """
    before, after = size // 2, size - 1 - size // 2
    wide = STRIP + size - 1
    line = [*scene, "row", "_strip"]

    def number(position):
        return F.floor(position / F.lit(STRIP)).cast("int")

    place = F.col("col") - F.col("_strip") * STRIP + before
    reached = F.sequence(number(F.col("col") - after), number(F.col("col") + before))
    strips = (
        pixels.withColumn("_strip", F.explode(reached))
        .select(*line, place.alias("_place"), "value")
        .groupBy(*line)
        .agg(*[F.max(F.when(F.col("_place") == i, F.col("value"))).alias(f"_v{i}") for i in range(wide)])
        .select(*line, F.array(*[f"_v{i}" for i in range(wide)]).alias("_values"))
    )
    steps = F.array(*[F.lit(r - before) for r in range(size)])
    asked = places.withColumnRenamed("row", "_centre").select(
        "*", F.posexplode(steps).alias("_line", "_step")
    )
    asked = asked.withColumns(
        {"row": F.col("_centre") + F.col("_step"), "_strip": number(F.col("col"))}
    )
    first = F.col("col") - F.col("_strip") * STRIP
    pieces = asked.join(strips.hint("merge"), line, "left").select(
        *scene,
        F.col("_centre").alias("row"),
        "col",
        "_line",
        *[F.get("_values", first + c).alias(f"_p{c}") for c in range(size)],
    )
    cells = [(r, c) for r in range(size) for c in range(size)]
    return (
        pieces.groupBy(*scene, "row", "col")
        .agg(
            *[
                F.max(F.when(F.col("_line") == r, F.col(f"_p{c}"))).alias(f"_v{r}_{c}")
                for r, c in cells
            ]
        )
        .select(
            *scene,
            "row",
            "col",
            F.array(
                *[F.coalesce(F.col(f"_v{r}_{c}"), F.lit(fill)).cast("float") for r, c in cells]
            ).alias("patch"),
        )
    )


def as_square(flat, size: int, channels: int = 1):
    """A flat row-major array as array(row) of array(col) of array(channel)."""
    def cell(start):
        return F.slice(flat, start + 1, channels)

    def line(r):
        first = r * F.lit(size * channels)
        return F.transform(
            F.sequence(F.lit(0), F.lit(size - 1)), lambda c: cell(first + c * F.lit(channels))
        )

    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), line)
