"""Rasters as pixel tables: (scene_ts, row, col, band, value), NULL = masked.

A mosaic holds one value per cell and band: that of one scene in the look-back
window [at - lookback, at). ``earliest`` takes the oldest valid scene, as images
sorted newest first and then laid over each other do; ``latest`` the newest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.geo import cell_index
from ..functions.hashing import seeded_hash
from ..functions.numbers import above, bin_of, class_of, stratum_of, zero_if_null
from ..functions.times import col, ntz, shift_hours, slot
from .joins import fits_broadcast

CELL = ["row", "col"]
#: Bitmaps that are broadcast at most, and what a row of them takes.
BITMAP_BYTES = 128 << 20
BITMAP_ROW = 4200


def scene_window(
    pixels: DataFrame,
    at: dt.datetime,
    lookback_hours: int = C.LOOKBACK_HOURS,
    bands: Sequence[str] | None = None,
) -> DataFrame:
    """Pixels of the scenes in [at - lookback, at); both ranges reach the scan."""
    start = at - dt.timedelta(hours=lookback_hours)
    seen = pixels.where((F.col("scene_ts") >= ntz(start)) & (F.col("scene_ts") < ntz(at)))
    return seen if bands is None else seen.where(F.col("band").isin(list(bands)))


def bands_like(pixels: DataFrame, pattern: str) -> DataFrame:
    """Pixels of the bands whose whole name matches the pattern."""
    return pixels.where(F.col("band").rlike(f"^(?:{pattern})$"))


def rename_band(pixels: DataFrame, name: str) -> DataFrame:
    """Give a one-band image another band name."""
    return pixels.withColumn("band", F.lit(name))


def _check(pick: str) -> None:
    if pick not in ("earliest", "latest"):
        raise ValueError("pick is 'earliest' or 'latest'")


def mosaic(
    pixels: DataFrame,
    by: Sequence[str] = ("row", "col", "band"),
    pick: str = "earliest",
    unique_times: bool = False,
) -> DataFrame:
    """One valid value per cell and band out of the scenes given.

    Scenes of one time are told apart by value. Where a cell has one scene per time
    at most, ``unique_times`` allows a plain hash aggregate instead.
    """
    _check(pick)
    valid = pixels.where(F.col("value").isNotNull())
    if unique_times:
        choose = F.min_by if pick == "earliest" else F.max_by
        return valid.groupBy(*by).agg(choose("value", "scene_ts").alias("value"))
    choose = F.min if pick == "earliest" else F.max
    best = valid.groupBy(*by).agg(choose(F.struct("scene_ts", "value")).alias("_best"))
    return best.select(*by, F.col("_best.value").alias("value"))


def mosaics_at(
    pixels: DataFrame,
    dates: DataFrame,
    lookback_hours: int = C.LOOKBACK_HOURS,
    pick: str = "earliest",
    unique_times: bool = False,
    pieces: int = 64,
    **bounds,
) -> DataFrame:
    """A mosaic for each moment in ``dates.at``: (at, row, col, band, value).

    Each date is placed in the hours its window touches, so that pixels meet it in
    an equi-join on the hour; the exact range is checked on top. Few dates are
    broadcast once measured. Otherwise an hour's pixels are dealt over ``pieces`` by their
    cell, and each piece gets the hour's windows.
    """
    start = shift_hours("at", -lookback_hours)
    hours = F.sequence(slot(start, 24), slot("at", 24))
    windows = dates.select("at").distinct().select("at", F.explode(hours).alias("_hour"))
    valid = pixels.where(F.col("value").isNotNull()).withColumn("_hour", slot("scene_ts", 24))
    on = ["_hour"]
    if fits_broadcast(windows, **bounds):
        windows = F.broadcast(windows)
    else:
        on = ["_hour", "_piece"]
        valid = valid.withColumn("_piece", F.pmod(F.hash(*CELL), F.lit(pieces)))
        every = F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))).alias("_piece")
        windows = windows.select("*", every).hint("merge")
    inside = (F.col("scene_ts") >= shift_hours("at", -lookback_hours)) & (
        F.col("scene_ts") < F.col("at")
    )
    return mosaic(
        valid.join(windows, on).where(inside),
        ("at", "row", "col", "band"),
        pick,
        unique_times,
    )


def stack_bands(images: Sequence[DataFrame]) -> DataFrame:
    """Several images, with bands of different names, as one image of all bands."""
    return reduce(lambda a, b: a.unionByName(b), images)


def to_bands(
    sequence: DataFrame, index: str, count: int, bands: Sequence[str], by: Sequence[str] = CELL
) -> DataFrame:
    """A sequence of images as one wide row per cell, with bands named ``{i}_{band}``.

    The names are given, so one pass pivots; a masked pixel is NULL.
    """
    name = F.concat(F.col(index).cast("string"), F.lit("_"), F.col("band"))
    names = [f"{i}_{band}" for i in range(count) for band in bands]
    return (
        sequence.withColumn("_name", name).groupBy(*by).pivot("_name", names).agg(F.max("value"))
    )


def fill_masked(
    image: DataFrame, grid: DataFrame, bands: Sequence[str], by: Sequence[str] = CELL
) -> DataFrame:
    """Every cell of the grid and every band, masked pixels as 0.

    Image rows and zero rows meet in one aggregate; no join.
    """
    zeros = grid.select(*by).select(
        *by, F.explode(F.array(*[F.lit(b) for b in bands])).alias("band")
    )
    rows = zeros.withColumn("value", F.lit(None).cast("double")).withColumn("_grid", F.lit(True))
    seen = image.select(*by, "band", F.col("value").cast("double"), F.lit(False).alias("_grid"))
    return (
        rows.unionByName(seen)
        .groupBy(*by, "band")
        .agg(F.max("value").alias("value"), F.max("_grid").alias("_grid"))
        .where("_grid")
        .select(*by, "band", zero_if_null("value").alias("value"))
    )


def mask_at_most(pixels: DataFrame, threshold: float = C.PRECIPITATION_SHOWN_ABOVE) -> DataFrame:
    """Mask the pixels that do not exceed the threshold."""
    return pixels.withColumn("value", above("value", threshold))


def colour_classes(
    pixels: DataFrame, palette: Sequence[str], stretch: tuple[float, float]
) -> DataFrame:
    """Add ``class`` and ``colour``: the palette step of the stretched value."""
    step = class_of("value", *stretch, len(palette))
    colours = F.array(*[F.lit(c) for c in palette])
    return pixels.withColumn("class", step).withColumn("colour", F.get(colours, F.col("class")))


def strata(
    precipitation: DataFrame,
    grid: DataFrame,
    dates: Sequence[dt.datetime],
    bins: int = C.NUM_BINS,
) -> DataFrame:
    """Both bins and the stratum of every grid cell at every date.

    ``precipitation`` is (at, row, col, value), ``grid`` is (row, col, elevation). Grid
    and image rows meet in one aggregate, which fills masked precipitation with 0 and
    attaches the elevation without a join.
    """
    moments = F.explode(F.array(*[ntz(d) for d in dates]))
    cells = grid.select(
        moments.alias("at"),
        *CELL,
        F.col("elevation").cast("double"),
        F.lit(None).cast("double").alias("value"),
        F.lit(True).alias("_grid"),
    )
    seen = precipitation.select(
        "at",
        *CELL,
        F.lit(None).cast("double").alias("elevation"),
        F.col("value").cast("double"),
        F.lit(False).alias("_grid"),
    )
    merged = (
        cells.unionByName(seen)
        .groupBy("at", *CELL)
        .agg(*[F.max(c).alias(c) for c in ("elevation", "value", "_grid")])
        .where("_grid")
    )
    return merged.select(
        "at",
        *CELL,
        bin_of(zero_if_null("value"), C.MAX_PRECIPITATION, bins).alias("precipitation_bin"),
        bin_of(zero_if_null("elevation"), C.MAX_ELEVATION, bins).alias("elevation_bin"),
    ).withColumn("stratum", stratum_of("elevation_bin", "precipitation_bin", bins))


def one_cell_per_stratum(
    cells: DataFrame, by: Sequence[str] = ("at",), seed: int = 0
) -> DataFrame:
    """One cell per group and stratum, chosen by a hash.

    A cell travels as one number, so the choice is a hash aggregate of two numbers:
    a stratum that holds most of the map shrinks to one row in each task.
    """
    low = F.col("col").cast("bigint").bitwiseAND(F.lit((1 << 32) - 1))
    packed = F.shiftleft(F.col("row").cast("bigint"), 32).bitwiseOR(low)
    draw = seeded_hash(seed, *by, *CELL)
    chosen = (
        cells.select(*by, "stratum", packed.alias("_cell"), draw.alias("_draw"))
        .groupBy(*by, "stratum")
        .agg(F.min_by("_cell", "_draw").alias("_cell"))
    )
    row = F.shiftright(F.col("_cell"), 32).cast("int")
    column = F.shiftright(F.shiftleft(F.col("_cell"), 32), 32).cast("int")
    return chosen.select(*by, "stratum", row.alias("row"), column.alias("col"))


def values_at(
    pixels: DataFrame,
    probes: DataFrame,
    carry: Sequence[str],
    lookback_hours: int = C.LOOKBACK_HOURS,
    pick: str = "earliest",
    slices_per_day: int = 1,
    **bounds,
) -> DataFrame:
    """The mosaic value that each probe (row, col, band, at) sees: ``carry`` + value.

    ``carry`` must identify a probe. NULL if no valid scene lies in the window.
    """
    near = _nearest(pixels, probes, carry, lookback_hours, pick, slices_per_day, **bounds)
    return near.groupBy(*carry).agg(_choose(pick)("_value", "_ts").alias("value"))


def _choose(pick: str):
    return F.min_by if pick == "earliest" else F.max_by


def _in_tile() -> tuple[dict[str, Column], Column]:
    """A cell's tile, and its place there: 128 rows of 256 cells, as many as a bitmap has bits."""
    tile = {"_tile_row": F.shiftright("row", 7), "_tile_col": F.shiftright("col", 8)}
    row, column = F.col("row").bitwiseAND(F.lit(127)), F.col("col").bitwiseAND(F.lit(255))
    return tile, (row * 256 + column).cast("bigint")


def cell_bitmaps(cells: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The cells as bitmaps of 4 KB, one per tile and value of ``by``; each task merges its own first."""
    tile, place = _in_tile()
    keyed = cells.where(F.col("row").isNotNull() & F.col("col").isNotNull()).select(*by, *[c.alias(n) for n, c in tile.items()], place.alias("_place"))
    return keyed.groupBy(*by, *tile).agg(F.bitmap_construct_agg("_place").alias("_bits"))


def in_bitmaps(
    pixels: DataFrame, bitmaps: DataFrame, by: Sequence[str] = (), max_bytes: int = BITMAP_BYTES
) -> DataFrame:
    """Pixels whose cell is set in the bitmap of its tile.

    A semi-join whose right side has a row per tile instead of one per cell, so a hundredfold of
    cells fits the broadcast; beyond ``max_bytes`` of bitmaps the tiles are merged.
    """
    tile, place = _in_tile()
    keys = [*by, *tile]
    small = fits_broadcast(bitmaps.select(*keys), max_bytes // BITMAP_ROW, max_bytes)
    placed = pixels.withColumns({**tile, "_place": place})
    found = placed.join(F.broadcast(bitmaps) if small else bitmaps.hint("merge"), keys)
    byte = F.expr("cast(conv(hex(substring(_bits, cast(_place div 8 as int) + 1, 1)), 16, 10) as bigint)")
    bit = F.expr("cast(_place % 8 as int)")
    return found.where(F.call_function("shiftright", byte, bit).bitwiseAND(F.lit(1)) == 1).select(*pixels.columns)


def _nearest(
    pixels: DataFrame,
    probes: DataFrame,
    carry: Sequence[str],
    lookback_hours: int,
    pick: str,
    slices_per_day: int,
    **bounds,
) -> DataFrame:
    """``carry`` with the time and value of the best pixel in each slice of a probe's
    window; both NULL where a slice has none.

    No pair of pixel and probe is built. Time is cut into slices, a probe goes to
    the slices its window touches, and one sort per cell, band and slice passes the
    nearest valid pixel on to each probe. A busy cell is thus split by time;
    ``slices_per_day`` splits it further. Times of different slices differ, so the
    best of a probe's slices needs no tie-break.
    """
    _check(pick)
    if 24 % slices_per_day:
        raise ValueError("slices_per_day must divide 24")
    earliest = pick == "earliest"
    start = shift_hours("at", -lookback_hours)
    place = [*CELL, "band", "_slice"]
    span = {"_first": slot(start, slices_per_day), "_last": slot("at", slices_per_day)}
    each = F.explode(F.sequence("_first", "_last")).alias("_slice")
    placed = probes.select(*dict.fromkeys([*carry, *CELL, "band", "at"])).withColumns(span)
    asked = placed.select("*", each).drop(*span)
    valid = pixels.where(F.col("value").isNotNull()).select(
        *CELL, "band", "scene_ts", "value", slot("scene_ts", slices_per_day).alias("_slice")
    )
    # Only pixels of wanted cells and slices go on. Distinct before the slices are multiplied out,
    # and after; without the band, which would multiply them again.
    wanted = placed.select(*CELL, *span).distinct().select(*CELL, each).distinct()
    if fits_broadcast(wanted, **bounds):
        valid = valid.join(F.broadcast(wanted), wanted.columns, "left_semi")
    else:
        valid = in_bitmaps(valid, cell_bitmaps(wanted, ["_slice"]), ["_slice"])
    valid = valid.select(*place, "scene_ts", "value")

    # Earliest reads time backwards: the last pixel before a probe in that order is the
    # first one from its window's start on. A pixel on the start counts, one on the end does not.
    pixel_rows = valid.select(
        *place,
        F.col("scene_ts").alias("_pos"),
        F.lit(0 if earliest else 1).alias("_turn"),
        F.struct("scene_ts", "value").alias("_hit"),
        F.lit(False).alias("_asks"),
        *[F.lit(None).cast(kind).alias(f"_c_{c}") for c, kind in _kinds(probes, carry)],
        F.lit(None).cast("timestamp_ntz").alias("_at"),
    )
    nothing = F.lit(None).cast(pixel_rows.schema["_hit"].dataType)
    probe_rows = asked.select(
        *place,
        (start if earliest else F.col("at")).alias("_pos"),
        F.lit(1 if earliest else 0).alias("_turn"),
        nothing.alias("_hit"),
        F.lit(True).alias("_asks"),
        *[F.col(c).alias(f"_c_{c}") for c in carry],
        F.col("at").alias("_at"),
    )
    by_time = [F.desc("_pos") if earliest else F.asc("_pos"), F.asc("_turn")]
    by_value = F.desc("_hit.value") if earliest else F.asc("_hit.value")
    order = Window.partitionBy(*place).orderBy(*by_time, by_value)
    hit = F.last("_hit", ignorenulls=True).over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = pixel_rows.union(probe_rows).withColumn("_hit", hit).where("_asks")
    inside = (F.col("_hit.scene_ts") >= shift_hours("_at", -lookback_hours)) & (
        F.col("_hit.scene_ts") < F.col("_at")
    )
    return seen.select(
        *[F.col(f"_c_{c}").alias(c) for c in carry],
        F.when(inside, F.col("_hit.scene_ts")).alias("_ts"),
        F.when(inside, F.col("_hit.value")).alias("_value"),
    )


def _kinds(df: DataFrame, names: Sequence[str]) -> list[tuple[str, str]]:
    kinds = dict(df.dtypes)
    return [(n, kinds[n]) for n in names]


def lagged_features(
    pixels: DataFrame,
    points: DataFrame,
    hours: Mapping[str, int],
    band: str,
    fill: float | None = 0.0,
    lookback_hours: int = C.LOOKBACK_HOURS,
    pick: str = "earliest",
    slices_per_day: int = 1,
    **bounds,
) -> DataFrame:
    """For each distinct point (at, row, col), the band's value at ``at`` + h hours.

    One column per entry of ``hours``; masked pixels get ``fill``.
    """
    lags = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(h).alias("h")) for n, h in hours.items()]
    )
    probes = (
        points.select("at", *CELL)
        .distinct()
        .withColumn("lag", F.explode(lags))
        .select(
            F.col("at").alias("point_at"),
            *CELL,
            F.lit(band).alias("band"),
            F.col("lag.name").alias("name"),
            shift_hours("at", F.col("lag.h")).alias("at"),
        )
    )
    carry = ["point_at", *CELL, "name"]
    near = _nearest(pixels, probes, carry, lookback_hours, pick, slices_per_day, **bounds)

    def seen(name: str) -> Column:
        value = _choose(pick)("_value", F.when(F.col("name") == name, F.col("_ts")))
        return (value if fill is None else F.coalesce(value, F.lit(fill))).alias(name)

    return near.groupBy(F.col("point_at").alias("at"), *CELL).agg(*[seen(n) for n in hours])


def cell_columns(
    lon: Column | str, lat: Column | str, west: float, north: float, size: float
) -> dict[str, Column]:
    """Row and column of a point on a north-up grid with this corner and cell size."""
    return {"row": cell_index(-col(lat), -north, size), "col": cell_index(lon, west, size)}
