"""Points in many polygons against every edge counted by hand."""

import random

import pytest

from aerowx.operators.regions import cover, in_regions


def inside(ring, x, y):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) / (y2 - y1) * (y - y1) + x1:
            odd = not odd
    return odd


@pytest.fixture(scope="module")
def world(spark):
    draw = random.Random(4)
    rings = {0: [(-140.0, 60.0), (-140.0, -60.0), (-10.0, -60.0), (-10.0, 60.0)], 1: [(0.0, 0.0), (1.0, 1.0)], 2: []}
    for k in range(3, 12):
        x, y = draw.uniform(-150, 150), draw.uniform(-60, 60)
        rings[k] = [(x + draw.uniform(-40, 40), y + draw.uniform(-30, 30)) for _ in range(draw.randint(3, 7))]
    rings[20] = [(10.0, 10.0), (10.001, 10.0), (10.0, 10.001)]
    points = [(i, draw.uniform(-190, 190), draw.uniform(-95, 95)) for i in range(1500)]
    points += [(5000, 10.0002, 10.0002), (5001, None, 1.0), (5002, 1.0, None), (5003, -140.0, 0.0), (5004, -10.0, 60.0)]
    polygons = spark.createDataFrame(list(rings.items()), "region_id int, ring array<struct<lon: double, lat: double>>")
    want = [(i, k) for i, x, y in points if x is not None and y is not None for k, r in rings.items() if len(r) > 2 and inside(r, x, y)]
    return spark.createDataFrame(points, "id int, lon double, lat double"), polygons, sorted(want)


@pytest.mark.parametrize("bounds", [{}, {"max_rows": 0, "hot_rows": 5}])
@pytest.mark.parametrize("first, last", [(2, 7), (0, 3), (4, 4)])
def test_points_meet_the_polygons_they_lie_in(world, first, last, bounds):
    points, polygons, want = world
    found = in_regions(points, polygons, first=first, last=last, **bounds)
    assert found.columns == ["id", "lon", "lat", "region_id"]
    assert sorted((r.id, r.region_id) for r in found.collect()) == want


def test_large_cells_fill_the_middle_and_nothing_is_paired(world, plan_of):
    points, polygons, _ = world
    box = cover(polygons.where("region_id = 0"), last=8).collect()
    sure = [r for r in box if not r.border]
    # Two cells of 45 degrees lie inside, and the border takes a strip of the smallest.
    assert min(r.level for r in sure) == 3 and len(box) < 130 * 120 / (360 / 256) ** 2 / 3
    text = plan_of(in_regions(points, polygons))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_polygons_and_no_points(world):
    points, polygons, _ = world
    assert in_regions(points, polygons.limit(0)).count() == 0 and in_regions(points.limit(0), polygons).count() == 0
