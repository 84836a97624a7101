import datetime as dt
import json

import pytest

from aerowx import contracts as C
from aerowx import sinks
from aerowx.functions.curve import curve_key
from aerowx.operators import lookups, quality
from aerowx.operators.conform import cast_to
from aerowx.sources import files, jdbc
from aerowx.training_files import read_set, write_set


def test_appending_twice_adds_nothing(spark, rows):
    day = dt.date(2023, 1, 1)
    incoming = spark.createDataFrame(
        [("A", day, 1), ("A", day, 1), ("A", day, 0), ("B", day, 5)], "code string, day date, v int"
    )
    nothing = incoming.limit(0)
    for bounds in ({}, {"max_rows": 0}):
        first = sinks.new_rows(incoming, nothing, ["code", "day"], **bounds)
        assert rows(first) == [("A", day, 0), ("B", day, 5)]
        assert sinks.new_rows(incoming, first, ["code", "day"], **bounds).count() == 0
        part = first.where("code = 'A'")
        assert rows(sinks.new_rows(incoming, part, ["code", "day"], **bounds)) == [("B", day, 5)]


def test_a_folder_with_most_rows_is_split(spark, tmp_path, plan_of):
    for key, value in {"advisoryPartitionSizeInBytes": "2k", "coalescePartitions.minPartitionSize": "1k"}.items():
        spark.conf.set(f"spark.sql.adaptive.{key}", value)
    try:
        df = spark.range(20_000).selectExpr("if(id % 3 = 0, 'HOT', concat('K', id % 5)) as k", "id")
        sinks.write_partitioned(df.repartition(8), str(tmp_path / "t"), ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    assert len(list((tmp_path / "t" / "k=HOT").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20_000


def test_a_large_table_is_only_scanned(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    fresh = sinks.new_rows(spark.range(990, 1010), spark.read.parquet(path), ["id"])
    assert sorted(r["id"] for r in fresh.collect()) == list(range(1000, 1010))
    assert "SortMergeJoin" not in plan_of(fresh)


def test_parquet_and_json(spark, tmp_path, rows):
    df = spark.range(10).selectExpr("cast(id as int) as id", "concat('n', id) as name")
    sinks.write_parquet(df, str(tmp_path / "p"))
    sinks.write_parquet(df, str(tmp_path / "p"))
    assert rows(files.parquet(spark, str(tmp_path / "p"))) == rows(df)
    sinks.write_json(df, str(tmp_path / "j"))
    back = files.json_documents(spark, str(tmp_path / "j"), df.schema, multiline=False)
    assert rows(back) == rows(df)
    text = sinks.json_rows(df.limit(1), pretty=True).first()["json"]
    assert json.loads(text) == {"id": 0, "name": "n0"} and "\n" in text


def test_tables_are_recreated_empty(spark):
    for name, schema in C.TABLES.items():
        sinks.recreate_table(spark, name, schema)
        cast_to(spark.range(1), schema).write.insertInto(name)
        assert lookups.table_rows(spark, name).count() == 1
        assert lookups.table_rows(spark, name, "ACK").count() == 0
        profiled = quality.profile_catalog(spark).where(f"table_name = '{name}'")
        assert profiled.count() == len(schema) and profiled.first()["row_count"] == 1
        sinks.recreate_table(spark, name, schema)
        assert spark.table(name).count() == 0
        assert spark.table(name).schema.simpleString() == schema.simpleString()
        spark.sql(f"DROP TABLE {name}")


def test_only_known_tables(spark):
    with pytest.raises(ValueError):
        lookups.table_rows(spark, "airports; DROP TABLE airports")


class Writer:
    def __init__(self):
        self.calls = []

    @property
    def write(self):
        return self

    def jdbc(self, *call):
        self.calls.append(call)


def test_database_writes_keep_the_definition_and_bound_connections():
    writer = Writer()
    jdbc.write_table(writer, "jdbc:x", "airports", properties={"user": "u", "numPartitions": "4"})
    jdbc.write_table(writer, "jdbc:x", "airports", "append")
    (_, _, mode, options), (_, _, second, more) = writer.calls
    assert (mode, options["truncate"], options["numPartitions"]) == ("overwrite", "true", "4")
    assert second == "append" and "truncate" not in more and more["numPartitions"] == "16"
    with pytest.raises(ValueError):
        jdbc.write_table(writer, "jdbc:x", "airports", "replace")


def test_rows_without_a_key_are_all_new(spark):
    incoming = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (5, 3), (5, 3), (6, 4)], "k int, v int")
    existing = spark.createDataFrame([(6, 0), (None, 0)], "k int, v int")
    for bounds in ({}, {"max_rows": 0}):
        new = sinks.new_rows(incoming, existing, ["k"], **bounds)
        assert sorted((tuple(r) for r in new.collect()), key=repr) == [(5, 3), (None, 1), (None, 1), (None, 2)]


def test_only_identifiers_name_tables(spark):
    with pytest.raises(ValueError):
        sinks.recreate_table(spark, "a; DROP TABLE b", None)


def test_a_training_set_appears_whole_and_is_replaced_whole(spark, tmp_path, rows):
    folder = str(tmp_path / "set")
    arrays = ["array(array(float(id), 2f)) as inputs", "array(array(float(-id))) as labels"]
    df = spark.range(40).repartition(3).selectExpr("id as batch_id", *arrays)
    shapes = ((1, 2, 1), (1, 1, 1))
    entry = write_set(df, folder, *shapes, name="a")
    assert (entry["files"], entry["examples"]) == (40, 40)
    write_set(df.where("batch_id < 3"), folder, *shapes, name="b")
    # The same set again: nothing of the first run stays, and the other set does.
    write_set(df.where("batch_id < 5"), folder, *shapes, name="a")
    assert read_set(spark, folder).count() == 8
    assert rows(read_set(spark, folder, "a"))[4] == (4, 1, [4.0, 2.0], [-4.0])
    before = rows(read_set(spark, folder, "b"))
    # A task fails after others have written: the set stays as it was, and no file is left.
    broken = df.selectExpr("batch_id", "if(batch_id = 33, array(array(1f)), inputs) as inputs", "labels")
    with pytest.raises(Exception):
        write_set(broken, folder, *shapes, name="b")
    assert rows(read_set(spark, folder, "b")) == before
    assert len(list((tmp_path / "set" / "data").iterdir())) == 2
    write_set(df.limit(0), folder, *shapes, name="none", replace_others=True)
    assert read_set(spark, folder).count() == 0 and not list((tmp_path / "set").glob("data/*/*/*.npz"))
    with pytest.raises(ValueError):
        write_set(df, folder, *shapes, name="../x")


def test_files_that_no_manifest_names_are_not_read(spark, tmp_path):
    folder = str(tmp_path / "set")
    df = spark.range(6).selectExpr("id as batch_id", "array(1f) as inputs", "array(2f) as labels")
    write_set(df, folder, (1, 1, 1), (1, 1, 1))
    stray = next((tmp_path / "set" / "data").iterdir()) / "99-99"
    stray.mkdir()
    (stray / "_list.json").write_text("[7]")
    (stray / "7.npz").write_bytes(b"half a file")
    assert read_set(spark, folder).count() == 6


def test_files_along_the_curve_cover_small_boxes(spark, tmp_path):
    import pyarrow.parquet as pq

    rows = spark.range(64 * 32 * 32).selectExpr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(id % 64 as int), 5) as scene_ts",
        "cast(id div 64 % 32 as int) as row", "cast(id div 2048 as int) as col", "'b' as band", "1.0D as value",
    )
    path = tmp_path / "curve"
    sinks.write_by_curve(rows, str(path), ("2024-01-01", 0, 0), files=64)
    hit = {"day": 0, "row": 0, "col": 0}
    parts = list(path.glob("*.parquet"))
    for part in parts:
        group = pq.ParquetFile(part).metadata.row_group(0)
        by_name = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
        day = dt.datetime(2024, 1, 20, 5)
        hit["day"] += by_name["scene_ts"].min <= day <= by_name["scene_ts"].max
        hit["row"] += by_name["row"].min <= 9 <= by_name["row"].max
        hit["col"] += by_name["col"].min <= 9 <= by_name["col"].max
    # A sort by one dimension would read all files for the two others.
    assert len(parts) == 64 and all(n <= 44 for n in hit.values()), hit
    assert spark.read.parquet(str(path)).count() == 64 * 32 * 32


def test_the_curve_takes_bits_in_turn(spark):
    cells = [(x, y, z) for x in (0, 1, 5, 1 << 20) for y in (0, 3, 70) for z in (0, 2, 2_000_000)] + [(-4, 1 << 30, 0)]
    df = spark.createDataFrame([*cells, (None, 1, 1)], "x long, y long, z long")
    for r in df.select("*", curve_key("x", "y", "z").alias("k")).collect():
        if r.x is None:
            assert r.k is None
            continue
        clipped = [min(max(v, 0), (1 << 21) - 1) for v in (r.x, r.y, r.z)]
        want = sum((v >> i & 1) << (3 * i + 2 - d) for d, v in enumerate(clipped) for i in range(21))
        assert r.k == want
