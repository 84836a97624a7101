"""Rasters of different resolutions on one grid.

Grids share their origin; a cell of a grid of ``scale`` metres covers [row * scale, (row + 1) * scale)
and the same of columns. All arithmetic on cells is in whole metres, so no edge is a matter of rounding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable

#: Metres per pixel of the common grid that examples are sampled on (fixed value).
SCALE = 10_000


def _floor(a: Column, b: Column) -> Column:
    """a / b, rounded down, of whole numbers; b is positive."""
    return ((a - F.pmod(a, b)) / b).cast("long")


def _scale_of(scales: Mapping[str, int]) -> Column:
    if any(s <= 0 or s != int(s) for s in scales.values()):
        raise ValueError("scales are whole metres above 0")
    listed = F.create_map(*[F.lit(x) for band, s in scales.items() for x in (band, int(s))])
    return F.try_element_at(listed, F.col("band")).cast("long")


def _centres_in(position: str, to: int) -> Column:
    """Cells of the new grid whose centre lies in a cell of the old one; none, one or a run."""
    start, twice = F.col(position).cast("long") * F.col("_scale"), F.lit(2 * to).cast("long")
    # Centre (t + 1/2) * to >= edge, so t >= (2 * edge - to) / (2 * to), rounded up.
    first = -_floor(-(2 * start - to), twice)
    after = -_floor(-(2 * (start + F.col("_scale")) - to), twice)
    return F.when(first < after, F.sequence(first, after - 1)).otherwise(F.array().cast("array<bigint>"))


def nearest(pixels: DataFrame, scales: Mapping[str, int], to: int = SCALE) -> DataFrame:
    """Pixels (row, col, band, value and others) on the grid of ``to`` metres, by the pixel at each cell's centre.

    ``scales`` names the metres per pixel of each band; bands that it does not name are left out.
    A fine band is cut down where it is read, since a pixel knows whether it holds a centre; a
    coarse one is repeated in the cells it covers. Nothing is shuffled. Masked pixels stay masked.
    """
    given = pixels.withColumn("_scale", _scale_of(scales)).where("_scale IS NOT NULL")
    rows = given.withColumn("row", F.explode(_centres_in("row", to)))
    cells = rows.withColumn("col", F.explode(_centres_in("col", to)))
    return cells.withColumns({"row": F.col("row").cast("int"), "col": F.col("col").cast("int")}).drop("_scale")


def _shared(position: str, to: int) -> Column:
    """(cell, metres) for each cell of the new grid that a cell of the old one meets."""
    start = F.col(position).cast("long") * F.col("_scale")
    end, step = start + F.col("_scale"), F.lit(to).cast("long")
    return F.transform(
        F.sequence(_floor(start, step), _floor(end - 1, step)),
        lambda t: F.struct(t.alias("cell"), (F.least(end, (t + 1) * to) - F.greatest(start, t * to)).alias("metres")),
    )


def mean(
    pixels: DataFrame, scales: Mapping[str, int], to: int = SCALE, by: Sequence[str] = ()
) -> DataFrame:
    """(by, row, col, band, value, area): means of valid pixels, weighted by the square metres they share.

    ``by`` are columns that tell images apart, such as the scene's time. A cell without a valid
    pixel has no row. Sums shrink in each task before the shuffle. Decimal values give sums that do
    not depend on their order; the mean is a double.
    """
    given = pixels.where("value IS NOT NULL").withColumn("_scale", _scale_of(scales)).where("_scale IS NOT NULL")
    met = given.withColumn("_r", F.explode(_shared("row", to))).withColumn("_c", F.explode(_shared("col", to)))
    area = F.col("_r.metres") * F.col("_c.metres")
    cells = met.select(
        *by, F.col("_r.cell").cast("int").alias("row"), F.col("_c.cell").cast("int").alias("col"), "band", "value", area.alias("_area")
    )
    sums = cells.groupBy(*by, "row", "col", "band").agg(
        F.sum(F.col("value") * F.col("_area").cast("decimal(18,0)" if "decimal" in dict(pixels.dtypes)["value"] else "double")).alias("_sum"),
        F.sum("_area").alias("area"),
    )
    return sums.select(*by, "row", "col", "band", (F.col("_sum").cast("double") / F.col("area")).alias("value"), "area")


def pyramid(pixels: DataFrame, levels: int, by: Sequence[str] = ()) -> DataFrame:
    """(level, by, row, col, band, total, pixels): overviews, each with half the rows and columns of the one below.

    Level 0 is the raster itself. Sums and counts are kept instead of means, so a level follows
    from the one below exactly and masked pixels weigh nothing; the mean is total / pixels. A level
    is written before the next reads it: all levels together are a third more than the raster.
    """
    cell = [*by, "row", "col", "band"]
    below = pixels.where("value IS NOT NULL").groupBy(*cell).agg(F.sum("value").alias("total"), F.count("value").alias("pixels"))
    found = None
    for level in range(levels + 1):
        if level:
            half = {c: F.floor(F.col(c) / F.lit(2)).cast("int") for c in ("row", "col")}
            kind = dict(below.dtypes)["total"]
            below = below.withColumns(half).groupBy(*cell).agg(
                F.sum("total").cast(kind).alias("total"), F.sum("pixels").alias("pixels")
            )
        below = durable(below)
        layer = below.select(F.lit(level).alias("level"), *cell, "total", "pixels")
        found = layer if found is None else found.unionByName(layer)
    return found
