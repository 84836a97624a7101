import datetime as dt
import random

import pytest

from aerowx import contracts as C
from aerowx.functions.geo import in_region, square_bounds
from aerowx.operators import patches, raster

T0 = dt.datetime(2024, 1, 10, 12, 0)
H = dt.timedelta(hours=1)
SCHEMA = "scene_ts timestamp_ntz, row int, col int, band string, value double"
BAND = "precipitationCal"


@pytest.fixture(scope="module")
def scenes(spark):
    return spark.createDataFrame(
        [
            # Masked in the newest scene, valid in the oldest, and the other way round.
            (T0 - 20 * H, 0, 0, BAND, 1.0),
            (T0 - 2 * H, 0, 0, BAND, None),
            (T0 - 20 * H, 0, 1, BAND, None),
            (T0 - 2 * H, 0, 1, BAND, 2.0),
            # Masked in all scenes.
            (T0 - 2 * H, 0, 2, BAND, None),
            # On the window's start, on its end, and before it.
            (T0 - 24 * H, 0, 3, BAND, 3.0),
            (T0 - 5 * H, 0, 3, BAND, 4.0),
            (T0, 0, 4, BAND, 5.0),
            (T0 - 25 * H, 0, 5, BAND, 6.0),
            # Two scenes at one time.
            (T0 - H, 0, 6, BAND, 8.0),
            (T0 - H, 0, 6, BAND, 7.0),
            # Another band.
            (T0 - H, 0, 0, "CMI_C01", 9.0),
            (T0 - H, 0, 0, "CMI_D01", 9.5),
        ],
        SCHEMA,
    ).cache()


def cells(df):
    return {r["col"]: r["value"] for r in df.collect()}


def test_mosaic_of_a_window(scenes):
    seen = raster.scene_window(scenes, T0, bands=[BAND])
    assert cells(raster.mosaic(seen)) == {0: 1.0, 1: 2.0, 3: 3.0, 6: 7.0}
    assert cells(raster.mosaic(seen, pick="latest")) == {0: 1.0, 1: 2.0, 3: 4.0, 6: 8.0}
    with pytest.raises(ValueError):
        raster.mosaic(seen, pick="any")


def test_masked_pixels_are_zero_only_after_the_mosaic(spark, scenes):
    grid = spark.range(8).selectExpr("0 as row", "cast(id as int) as col")
    image = raster.mosaic(raster.scene_window(scenes, T0, bands=[BAND]))
    filled = raster.fill_masked(image, grid, [BAND])
    assert cells(filled) == {0: 1.0, 1: 2.0, 2: 0.0, 3: 3.0, 4: 0.0, 5: 0.0, 6: 7.0, 7: 0.0}


def test_bands_by_pattern(scenes):
    found = raster.bands_like(scenes, C.IMAGER_BANDS).select("band").distinct().collect()
    assert [r["band"] for r in found] == ["CMI_C01"]


def test_sequence_names(spark):
    images = spark.createDataFrame(
        [(0, 1, 1, "p", 1.0), (1, 1, 1, "p", 2.0), (1, 1, 1, "q", 3.0)],
        "i int, row int, col int, band string, value double",
    )
    wide = raster.to_bands(images, "i", 2, ["p", "q"])
    assert wide.columns == ["row", "col", "0_p", "0_q", "1_p", "1_q"]
    assert tuple(wide.first()) == (1, 1, 1.0, None, 2.0, 3.0)


def test_threshold_is_strict_and_classes_are_clamped(spark):
    pixels = spark.createDataFrame([(0.1,), (0.11,), (-3.0,), (20.0,), (19.9,), (None,)], "value double")
    shown = [r["value"] for r in raster.mask_at_most(pixels).collect()]
    assert shown == [None, 0.11, None, 20.0, 19.9, None]
    classed = raster.colour_classes(pixels, C.PRECIPITATION_PALETTE, C.PRECIPITATION_STRETCH)
    assert [r["class"] for r in classed.collect()] == [0, 0, 0, 9, 9, None]
    assert classed.where("value = 20").first()["colour"] == "af0000"


def test_bins_are_clamped_and_cut_down(spark):
    from aerowx.functions.numbers import bin_of, stratum_of

    found = spark.createDataFrame(
        [(-5.0, 7000.0), (0.0, 6000.0), (3.4, 700.0), (30.0, 5999.0), (99.0, -1.0)],
        "rain double, height double",
    ).select(bin_of("rain", 30, 10).alias("p"), bin_of("height", 6000, 10).alias("e"))
    got = [tuple(r) for r in found.select("p", "e", stratum_of("e", "p", 10)).collect()]
    assert got == [(0, 9, 90), (0, 9, 90), (1, 1, 11), (9, 8, 89), (9, 0, 9)]


def brute(pixels, row, col, at, hours, pick):
    inside = [
        (ts, v)
        for ts, r, c, b, v in pixels
        if (r, c, b) == (row, col, BAND) and v is not None and at - hours * H <= ts < at
    ]
    if not inside:
        return None
    return (min if pick == "earliest" else max)(inside)[1]


@pytest.mark.parametrize("pick", ["earliest", "latest"])
@pytest.mark.parametrize("per_day, hours", [(1, 24), (4, 24), (24, 5), (1, 60)])
@pytest.mark.parametrize("small", [True, False])
def test_values_at_agree_with_brute_force(spark, pick, per_day, hours, small):
    draw = random.Random(per_day * 100 + hours)
    # Whole half hours, so that times collide with each other and with window edges.
    pixels = [
        (T0 + draw.randrange(-200, 60) * H / 2, draw.randrange(2), draw.randrange(2),
         draw.choice([BAND, BAND, "other"]), draw.choice([None, *range(20)]))
        for _ in range(250)
    ]
    pixels = [(a, b, c, d, None if e is None else float(e)) for a, b, c, d, e in pixels]
    asked = [
        (i, draw.randrange(3), draw.randrange(2), BAND, T0 + draw.randrange(-100, 60) * H / 2)
        for i in range(60)
    ]
    found = raster.values_at(
        spark.createDataFrame(pixels, SCHEMA),
        spark.createDataFrame(asked, "id int, row int, col int, band string, at timestamp_ntz"),
        ["id"],
        lookback_hours=hours,
        pick=pick,
        slices_per_day=per_day,
        max_rows=10_000 if small else 0,
    )
    got = {r["id"]: r["value"] for r in found.collect()}
    assert got == {i: brute(pixels, r, c, at, hours, pick) for i, r, c, _, at in asked}


def test_a_busy_cell_gives_no_pairs(spark):
    """Probes and pixels of one cell pass through a sort; the one join is with bitmaps of tiles."""
    pixels = spark.createDataFrame([(T0, 0, 0, BAND, 1.0)], SCHEMA)
    points = spark.createDataFrame([(T0, 0, 0)], "at timestamp_ntz, row int, col int")
    plan = raster.lagged_features(pixels, points, {"h": 2}, BAND, max_rows=0)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Join") == 1 and "bitmap_construct_agg" in text


@pytest.mark.parametrize("max_bytes", [1 << 20, 0])
def test_bitmaps_keep_the_listed_cells_only(spark, max_bytes):
    draw = random.Random(8)
    cell = lambda: (draw.randrange(-300, 300), draw.randrange(-600, 600), draw.randrange(2))
    listed = [cell() for _ in range(400)] + [(-1, -1, 0), (127, 255, 1), (128, 256, 1), (None, 3, 0)]
    asked = listed + [cell() for _ in range(2000)] + [(3, None, 0)]
    schema = "row int, col int, day int"
    bitmaps = raster.cell_bitmaps(spark.createDataFrame(listed, schema), ["day"])
    found = raster.in_bitmaps(spark.createDataFrame(asked, schema), bitmaps, ["day"], max_bytes)
    want = [a for a in asked if a in set(listed) and a[0] is not None]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert bitmaps.count() < len(listed) / 4 and found.columns == ["row", "col", "day"]


def test_mosaics_at_each_date(spark, scenes):
    dates = spark.createDataFrame([(T0,), (T0 + H,), (T0 - 100 * H,)], "at timestamp_ntz")
    found = raster.mosaics_at(scenes.where(f"band = '{BAND}'"), dates)
    got = {(r["at"] - T0, r["col"]): r["value"] for r in found.collect()}
    zero = dt.timedelta()
    assert got == {
        (zero, 0): 1.0, (zero, 1): 2.0, (zero, 3): 3.0, (zero, 6): 7.0,
        (H, 0): 1.0, (H, 1): 2.0, (H, 3): 4.0, (H, 4): 5.0, (H, 6): 7.0,
    }


@pytest.mark.parametrize("small", [True, False])
def test_patches_agree_with_brute_force(spark, small):
    draw = random.Random(5)
    values = {(s, r, c): float(draw.randrange(1, 99)) for s in (1, 2) for r in range(6)
              for c in range(6) if draw.random() < 0.8}
    pixels = spark.createDataFrame(
        [(*k, v) for k, v in values.items()], "scene int, row int, col int, value double"
    )
    centres = [(1, 0, 0), (1, 3, 3), (1, 3, 3), (2, 5, 2), (2, 40, 40), (3, 1, 1)]
    found = patches.extract_patches(
        pixels, spark.createDataFrame(centres, "scene int, row int, col int"), 5,
        max_rows=10_000 if small else 0,
    )
    got = {(r["scene"], r["row"], r["col"]): r["patch"] for r in found.collect()}
    assert got == {
        (s, r, c): [values.get((s, r + i, c + j), 0.0) for i in range(-2, 3) for j in range(-2, 3)]
        for s, r, c in set(centres)
    }


def test_flat_patch_as_square(spark):
    flat = spark.createDataFrame([(list(range(8)),)], "p array<int>")
    square = flat.select(patches.as_square(flat["p"], 2, 2)).first()[0]
    assert square == [[[0, 1], [2, 3]], [[4, 5], [6, 7]]]


def test_region(spark):
    points = [(-140.0, 60.0), (-75.0, 0.0), (-9.9, 0.0), (-75.0, 60.1), (None, 0.0)]
    df = spark.createDataFrame(points, "lon double, lat double")
    box = [r[0] for r in df.select(in_region("lon", "lat", C.REGION)).collect()]
    assert box == [True, True, False, False, None]
    arrow = [(0.0, 0.0), (4.0, 4.0), (0.0, 8.0), (2.0, 4.0)]  # not convex
    inside = spark.createDataFrame([(2.5, 4.0), (1.0, 4.0), (1.0, 1.5), (3.0, 0.5)], "x double, y double")
    got = [r[0] for r in inside.select(in_region("x", "y", arrow)).collect()]
    assert got == [True, False, True, False]


def test_square_round_a_point(spark):
    bounds = square_bounds("lon", "lat", 25_000)
    df = spark.createDataFrame([(10.0, 60.0)], "lon double, lat double")
    row = df.select(*[c.alias(n) for n, c in bounds.items()]).first()
    up = 25_000 / 111_320
    assert row["north"] - 60 == pytest.approx(up)
    assert row["east"] - 10 == pytest.approx(2 * up)


def test_cells_of_points(spark):
    df = spark.createDataFrame([(-139.9, 59.9), (-140.0, 60.0), (-139.0, 58.0)], "lon double, lat double")
    found = df.select(*raster.cell_columns("lon", "lat", -140.0, 60.0, 0.5).values())
    assert [tuple(r) for r in found.collect()] == [(0, 0), (0, 0), (4, 2)]


def test_map_layers(spark, scenes):
    from aerowx.plans import maps

    rain = maps.precipitation_layer(scenes, T0)
    assert {r["col"]: (r["class"], r["colour"]) for r in rain.collect()} == {
        0: (0, "000096"), 1: (1, "0064ff"), 3: (1, "0064ff"), 6: (3, "33db80"),
    }
    grid = spark.createDataFrame([(0, 0, 3000.0), (0, 1, None)], "row int, col int, elevation double")
    heights = {r["col"]: r["colour"] for r in maps.elevation_layer(grid).collect()}
    assert heights == {0: "FFFFFF", 1: None}
    picture = maps.imager_layer(scenes.withColumn("value", scenes["value"] * 200), T0, grid)
    assert {r["col"]: tuple(r)[2:] for r in picture.collect()} == {0: (0, 0, 153), 1: (0, 0, 0)}
    assert maps.layer_moments(T0, C.LABEL_HOURS) == [T0 + 2 * H, T0 + 6 * H]


def test_many_dates_do_not_meet_on_the_hour_alone(spark, rows):
    import datetime as dt

    pixels = spark.range(600).selectExpr(
        "timestamp_ntz'2023-01-01 00:00:00' + make_interval(0,0,0,0,if(id % 3 = 0, 5, id % 40)) AS scene_ts",
        "cast(id div 20 as int) AS row", "cast(id % 20 as int) AS col", "'b' AS band", "cast(id as double) AS value",
    )
    dates = spark.createDataFrame(
        [(dt.datetime(2023, 1, 1) + dt.timedelta(hours=h),) for h in (6, 12, 30)], "at timestamp_ntz"
    )
    dealt = raster.mosaics_at(pixels, dates, max_rows=0)
    text = dealt._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_hour#" in text and "_piece#" in text.split("hashpartitioning(_hour#")[1][:40]
    assert rows(dealt) == rows(raster.mosaics_at(pixels, dates)) != []
