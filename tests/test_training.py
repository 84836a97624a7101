import datetime as dt
import random
from pathlib import Path

import numpy as np
import pytest

from aerowx import contracts as C
from aerowx import sinks
from aerowx.plans import training as plan

START = dt.datetime(2024, 1, 10)
H = dt.timedelta(hours=1)
IMAGER = ["CMI_C01", "CMI_C02"]
SIDE = 8


@pytest.fixture(scope="module")
def world(spark):
    draw = random.Random(3)
    pixels = [
        (START + h * H, r, c, band, draw.choice([None, 0.0, draw.uniform(0, 40)]))
        for h in range(0, 72, 3)
        for r in range(SIDE)
        for c in range(SIDE)
        for band in [C.PRECIPITATION_BAND, *IMAGER]
    ]
    grid = [
        (r, c, float(draw.randrange(-100, 7000)), -100.0 + c, 40.0 - r if c < 7 else 80.0)
        for r in range(SIDE)
        for c in range(SIDE)
    ]
    return (
        pixels,
        grid,
        spark.createDataFrame(pixels, C.PIXELS).cache(),
        spark.createDataFrame(grid, "row int, col int, elevation double, lon double, lat double").cache(),
    )


DATES = [START + 40 * H, START + 50.5 * H]


def value(pixels, row, col, band, at):
    seen = [(ts, v) for ts, r, c, b, v in pixels
            if (r, c, b) == (row, col, band) and v is not None and at - 24 * H <= ts < at]
    return min(seen)[1] if seen else 0.0


def test_points_cover_every_stratum_once(world):
    pixels, grid, scenes, cells = world
    found = [tuple(r) for r in plan.sample_points(scenes, cells, DATES).select("at", "stratum", "row", "col").collect()]
    inside = [(r, c, e) for r, c, e, lon, lat in grid if lat <= 60]

    def stratum(at, r, c, e):
        rain = value(pixels, r, c, C.PRECIPITATION_BAND, at)
        return int(max(0, min(e, 6000)) / 6000 * 9) * 10 + int(max(0, min(rain, 30)) / 30 * 9)

    of_cell = {(at, r, c): stratum(at, r, c, e) for at in DATES for r, c, e in inside}
    assert sorted({(at, s) for (at, _, _), s in of_cell.items()}) == sorted((at, s) for at, s, _, _ in found)
    assert all(of_cell[at, r, c] == s for at, s, r, c in found)


def test_examples_agree_with_brute_force(spark, world):
    pixels, grid, scenes, cells = world
    heights = {(r, c): e for r, c, e, _, _ in grid}
    points = [(DATES[0], 0, 0), (DATES[1], 4, 5), (DATES[1], 7, 7)]
    found = plan.training_examples(
        scenes, cells, spark.createDataFrame(points, "at timestamp_ntz, row int, col int"), IMAGER, 3
    ).collect()
    assert len(found) == 3
    for row in found:
        inputs, labels = [], []
        for dr in (-1, 0, 1):
            for dc in (-1, 0, 1):
                r, c = row["row"] + dr, row["col"] + dc
                for h in C.INPUT_HOURS:
                    inputs.append(value(pixels, r, c, C.PRECIPITATION_BAND, row["at"] + h * H))
                for h in C.INPUT_HOURS:
                    inputs += [value(pixels, r, c, b, row["at"] + h * H) for b in IMAGER]
                inputs.append(heights.get((r, c), 0.0))
                labels += [value(pixels, r, c, C.PRECIPITATION_BAND, row["at"] + h * H) for h in C.LABEL_HOURS]
        assert row["inputs"] == pytest.approx(inputs, rel=1e-6)
        assert row["labels"] == pytest.approx(labels, rel=1e-6)


def test_batches_to_files(spark, world, tmp_path):
    _, _, scenes, cells = world
    examples, left_out = plan.training_batches(scenes, cells, DATES, IMAGER, patch_size=3, min_batch_size=5)
    examples = examples.cache()
    assert left_out.count() == 0
    batched = sinks.batches(examples)
    written = sinks.write_npz(batched, str(tmp_path), 3, 10, 2).collect()
    again = sinks.write_npz(batched, str(tmp_path), 3, 10, 2).collect()
    assert sorted(written) == sorted(again)
    total = 0
    for _, name in written:
        data = np.load(name)
        assert data["inputs"].shape[1:] == (3, 3, 10) and data["labels"].shape[1:] == (3, 3, 2)
        assert 5 <= len(data["inputs"]) == len(data["labels"]) < 10
        total += len(data["inputs"])
    assert total == examples.count()
    assert len(list(Path(tmp_path).iterdir())) == len(written)


def test_channel_order():
    assert plan.channels(IMAGER)[0] == ("inputs", 0, C.PRECIPITATION_BAND, -4)
    assert [c[:2] for c in plan.channels(IMAGER)][-2:] == [("labels", 0), ("labels", 1)]


def test_drawn_dates(spark):
    drawn = plan.draw_dates(spark, START, START + 100 * H)
    assert len(drawn) == C.NUM_DATES == len(set(drawn))
    assert drawn == plan.draw_dates(spark, START, START + 100 * H)
    assert drawn != plan.draw_dates(spark, START, START + 100 * H, seed=1)


def test_only_the_days_looked_at_are_read(spark, world, tmp_path, plan_of):
    _, _, scenes, _ = world
    path = str(tmp_path / "pixels")
    scenes.selectExpr("*", "cast(scene_ts as date) as day").write.partitionBy("day").parquet(path)
    table = spark.read.parquet(path)
    needed = plan.scenes_for(table, [START + 30 * H], day_column="day")
    days = {str(r["day"]) for r in needed.select("day").distinct().collect()}
    assert days == {"2024-01-10", "2024-01-11"}
    filters = [line for line in plan_of(needed).splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 1 and "day#" in filters[0] and "IN" in filters[0]


def test_only_the_ranges_of_dates_are_read(spark, tmp_path, plan_of):
    import datetime as dt

    from aerowx.plans.training import scenes_for

    path = str(tmp_path / "p")
    hours = spark.range(24 * 60).selectExpr("timestamp_ntz'2023-01-01 00:00:00' + make_interval(0,0,0,0,id) AS scene_ts")
    hours.write.parquet(path)
    dates = [dt.datetime(2023, 2, 20), dt.datetime(2023, 1, 3), dt.datetime(2023, 1, 3, 12)]
    seen = scenes_for(spark.read.parquet(path), dates, -24, 2)
    assert seen.count() == 38 + 26
    pushed = next(line for line in plan_of(seen).splitlines() if "PushedFilters" in line)
    assert all(day in pushed for day in ("2023-01-02", "2023-01-03", "2023-02-19", "2023-02-20"))


def test_training_files_take_their_parallelism_from_the_data(spark, tmp_path):
    import numpy as np

    from aerowx import sinks

    rows = [(b, [[float(b)] * 4] * 2, [[1.0] * 4] * 2) for b in range(3)]
    batched = spark.createDataFrame(rows, "batch_id long, inputs array<array<float>>, labels array<array<float>>")
    folder = f"file://{tmp_path}/set"
    for tasks in (None, 1):
        written = sinks.write_npz(batched.repartition(3), folder, 2, 1, 1, tasks)
        assert written.rdd.getNumPartitions() == (tasks or 3)
        assert written.count() == 3
    assert sorted(p.name for p in (tmp_path / "set").iterdir()) == ["0.npz", "1.npz", "2.npz"]
    assert np.load(tmp_path / "set" / "2.npz")["inputs"].tolist() == [[[[2.0], [2.0]], [[2.0], [2.0]]]] * 2
