"""Block rasters against patches cut pixel by pixel; grids of several resolutions against brute force."""

import random
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from aerowx.operators.blocks import patches_from_blocks, to_blocks, to_pixels, with_margin
from aerowx.operators.patches import extract_patches
from aerowx.operators.regrid import mean, nearest, pyramid

PIXELS = "scene int, row int, col int, value double"


@pytest.fixture(scope="module")
def raster(spark):
    rng = random.Random(3)
    cells = {(s, r, c) for s in (0, 1) for r in range(-9, 14) for c in range(-6, 11) if rng.random() < 0.6}
    rows = [(*cell, rng.choice([None, 0.5, -2.0, 7.25])) for cell in sorted(cells)]
    # A cell given twice, and one far from all others.
    return spark.createDataFrame([*rows, (0, 3, 3, 1.0), (0, 3, 3, 9.0), (1, 1000, -1000, 4.0)], PIXELS)


@pytest.mark.parametrize("size, side", [(3, 4), (5, 4), (4, 5), (1, 3), (6, 64)])
def test_patches_equal_those_cut_pixel_by_pixel(spark, raster, rows, size, side):
    centres = raster.select("scene", "row", "col").unionByName(
        spark.createDataFrame([(0, 500, 500), (7, 0, 0), (0, -10, -7)], "scene int, row int, col int")
    )
    got = patches_from_blocks(to_blocks(raster, side=side), centres, size, side=side, fill=-1.0)
    assert rows(got) == rows(extract_patches(raster, centres, size, fill=-1.0))


def test_blocks_hold_all_valid_pixels(raster, rows):
    stored = to_blocks(raster, side=4)
    assert stored.where(F.size("values") != 16).isEmpty()
    want = raster.where("value IS NOT NULL").groupBy("scene", "row", "col").agg(F.max("value").alias("value"))
    assert rows(to_pixels(stored, side=4)) == rows(want)
    assert stored.where("false").isEmpty() and to_blocks(raster.where("false")).isEmpty()


def test_blocks_send_borders_only(raster, plan_of):
    stored = to_blocks(raster, side=4)
    assert with_margin(stored, 1, side=4).where(F.size("values") != 36).isEmpty()
    with pytest.raises(ValueError):
        with_margin(stored, 5, side=4)
    text = plan_of(patches_from_blocks(stored, raster.select("scene", "row", "col"), 3, side=4))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange"):
        assert bad not in text


SCALES = {"fine": 3, "same": 10, "coarse": 25, "odd": 7}


def coloured(spark, kind="double"):
    rng = random.Random(5)
    rows = [(b, r, c, rng.choice([None, 1, 2, 5])) for b in [*SCALES, "unknown"] for r in range(-8, 12) for c in range(-3, 9)]
    df = spark.createDataFrame([(b, r, c, None if v is None else float(v)) for b, r, c, v in rows], "band string, row int, col int, value double")
    return df.withColumn("value", F.col("value").cast(kind)), [x for x in rows if x[0] in SCALES]


def test_nearest_takes_the_pixel_at_the_centre(spark, plan_of):
    df, rows = coloured(spark)
    given = {(b, r, c): v for b, r, c, v in rows}
    want = {}
    for band, scale in SCALES.items():
        for r in range(-30, 40):
            for c in range(-30, 40):
                # The centre of a cell of 10 metres, in cells of this band.
                cell = (band, (10 * r + 5) // scale, (10 * c + 5) // scale)
                if cell in given:
                    want[band, r, c] = given[cell]
    found = nearest(df, SCALES, 10)
    got = [((x.band, x.row, x.col), x.value) for x in found.collect()]
    assert len(got) == len(want) and dict(got) == want
    assert "Exchange" not in plan_of(found)
    with pytest.raises(ValueError):
        nearest(df, {"fine": 0})


@pytest.mark.parametrize("kind", ["double", "decimal(8,2)"])
def test_means_weigh_by_shared_area(spark, kind):
    df, rows = coloured(spark, kind)
    total, area = defaultdict(Fraction), defaultdict(int)
    for band, r, c, v in rows:
        if v is None:
            continue
        scale = SCALES[band]
        for y in range(scale):
            for x in range(scale):
                cell = (band, (r * scale + y) // 10, (c * scale + x) // 10)
                total[cell] += v
                area[cell] += 1
    got = {(x.band, x.row, x.col): x for x in mean(df, SCALES, 10).collect()}
    assert got.keys() == area.keys()
    for cell, x in got.items():
        assert x.area == area[cell] and x.value == pytest.approx(float(total[cell] / area[cell]))


def test_overviews_add_up(spark):
    df, _ = coloured(spark)
    found = pyramid(df, 6)
    by_level = {x.level: x for x in found.groupBy("level").agg(F.sum("total").alias("t"), F.sum("pixels").alias("n"), F.count("*").alias("cells")).collect()}
    assert len({(x.t, x.n) for x in by_level.values()}) == 1
    # Two quadrants in each direction meet at the origin, whatever the level.
    assert by_level[6].cells == 4 * 5 and by_level[1].cells < by_level[0].cells
    assert pyramid(df.where("false"), 2).isEmpty()
