"""Writes: parquet, monthly folders, JSON, tables, appends and training files."""

from __future__ import annotations

import io
import re
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.curve import curve_key
from .operators.flow import at_most_parallel
from .operators.joins import fits_broadcast
from .operators.sampling import first_per_key

# Ship this module's code with the tasks that write training files.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def write_parquet(df: DataFrame, path: str, max_rows_per_file: int = 5_000_000) -> None:
    df.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: Sequence[str] = ("airport_code", "year_month"),
    mode: str = "overwrite",
) -> None:
    """Hive-style folders with few files in each.

    Rebalanced, not repartitioned: a folder that takes a large share of the rows is
    split over tasks and files, and small ones share a task.
    """
    even = df.hint("rebalance", *[F.col(c) for c in by])
    even.write.mode(mode).partitionBy(*by).parquet(path)


def write_by_curve(
    pixels: DataFrame,
    path: str,
    origin: tuple[str, int, int],
    files: int | None = None,
    max_rows_per_file: int = 5_000_000,
) -> None:
    """Pixels in files and row groups that each cover a small box of days, rows and columns.

    ``origin`` is the first day, row and column. Parquet's own least and largest values then let a
    reader of one box and time skip most of the rest, whichever of the three it asks for. Times and
    bands break ties, so the pixels of one crowded cell are split too.
    """
    day, row, column = origin
    key = curve_key(F.datediff(F.col("scene_ts").cast("date"), F.lit(day).cast("date")), F.col("row") - row, F.col("col") - column)
    keyed = pixels.withColumn("_curve", key)
    order = ["_curve", "scene_ts", "band"]
    ranges = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    ordered = ranges.sortWithinPartitions(*order).drop("_curve")
    ordered.write.mode("overwrite").option("maxRecordsPerFile", max_rows_per_file).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def json_rows(df: DataFrame, name: str = "json", pretty: bool = False) -> DataFrame:
    """Each row as one JSON text."""
    options = {"pretty": str(pretty).lower()}
    return df.select(F.to_json(F.struct(*df.columns), options).alias(name))


def recreate_table(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Drop a table and create it empty under its contract.

    The name goes into SQL, so it may only be an identifier, with a database or without.
    """
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?", name):
        raise ValueError(f"not a table name: {name!r}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def new_rows(
    incoming: DataFrame,
    existing: DataFrame,
    keys: Sequence[str],
    prefer: Sequence[str] | None = None,
    **bounds,
) -> DataFrame:
    """Incoming rows to append: one per key, and none whose key is already there.

    Keys compare as in a join, so rows with a NULL key are always new, each of them. The incoming
    keys are broadcast once measured: a large table is then only scanned for them.
    """
    keys = list(keys)
    whole = reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])
    unkeyed = incoming.where(~whole)
    once = first_per_key(incoming.where(whole), keys, prefer)
    asked = once.select(*keys)
    if fits_broadcast(asked, **bounds):
        found = existing.select(*keys).join(F.broadcast(asked), keys, "left_semi").distinct()
        # No more of them than were asked for.
        return once.join(F.broadcast(found), keys, "left_anti").unionByName(unkeyed)
    there = existing.select(*keys)
    return once.join(there.hint("merge"), keys, "left_anti").unionByName(unkeyed)


def batches(
    examples: DataFrame, inputs: str = "inputs", labels: str = "labels", batch: str = "batch_id"
) -> DataFrame:
    """One row per batch: (batch_id, n_examples, inputs, labels) in ``example_no`` order.

    A batch holds fewer than twice the minimum size, so its arrays stay small.
    """
    parts = F.array_sort(F.collect_list(F.struct("example_no", inputs, labels)))
    return (
        examples.groupBy(batch)
        .agg(parts.alias("_parts"))
        .select(
            batch,
            F.size("_parts").alias("n_examples"),
            F.col(f"_parts.{inputs}").alias("inputs"),
            F.col(f"_parts.{labels}").alias("labels"),
        )
    )


def write_npz(
    batched: DataFrame,
    folder: str,
    patch_size: int,
    input_channels: int,
    label_channels: int,
    max_parallel: int | None = None,
) -> DataFrame:
    """Write each batch as ``{batch_id}.npz`` with arrays ``inputs`` and ``labels``
    of shape (examples, size, size, channels); returns (batch_id, file_name).

    A file is named after its batch, so a task that runs again replaces its own
    files. Nothing is written until the result is used. ``folder`` must be one that
    all executors share, and a new one for each set, since files of other batches stay in
    it. As many tasks write as there are partitions, or at most ``max_parallel``.
    """
    shapes = {
        "inputs": (-1, patch_size, patch_size, input_channels),
        "labels": (-1, patch_size, patch_size, label_channels),
    }

    def save(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root)
        attempt = TaskContext.get().taskAttemptId()
        for frame in frames:
            names = []
            for _, one in frame.iterrows():
                data = io.BytesIO()
                arrays = {
                    k: np.concatenate(list(one[k])).astype("float32").reshape(s)
                    for k, s in shapes.items()
                }
                np.savez_compressed(data, **arrays)
                name = f"{root}/{one['batch_id']}.npz"
                part = f"{name}.{attempt}.part"
                with store.open_output_stream(part) as out:
                    out.write(data.getvalue())
                # A local move replaces the file at once; other stores want the name free.
                local = isinstance(store, fs.LocalFileSystem)
                if not local and store.get_file_info(name).type != fs.FileType.NotFound:
                    store.delete_file(name)
                store.move(part, name)
                names.append(name)
            yield pd.DataFrame({"batch_id": frame["batch_id"], "file_name": names})

    schema = "batch_id bigint, file_name string"
    rows = batched.select(F.col("batch_id").cast("bigint"), "inputs", "labels")
    if max_parallel is not None:
        rows = at_most_parallel(rows, max_parallel, "batch_id")
    return rows.mapInPandas(save, schema)
