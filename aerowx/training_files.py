"""Training files as one committed set: a data source that writes and reads ``.npz`` batches.

Tasks write their files and a list of them under a folder of their own attempt; the job's commit
publishes the attempts that Spark accepted by one small manifest. A reader sees what the manifest
names and nothing else, so a failed job, a second attempt of a task or a file of an earlier run is
never read. Writing a set again under the same name replaces it, and other sets stay.

    folder/_manifest.json          sets, and the lists that belong to each
    folder/data/<set>-<job>/<attempt>/<batch>.npz
    folder/data/<set>-<job>/<attempt>/_list.json

The manifest has a line per task, not per file; the lists are read by the tasks that read the files.
"""

from __future__ import annotations

import io
import json
import re
import sys
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

# Ship this module's code with the tasks that write and read.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFEST = "_manifest.json"
SCHEMA = "batch_id bigint, n_examples int, inputs array<float>, labels array<float>"
_ARROW = pa.schema(
    [
        ("batch_id", pa.int64()),
        ("n_examples", pa.int32()),
        ("inputs", pa.list_(pa.float32())),
        ("labels", pa.list_(pa.float32())),
    ]
)


class Store:
    """A folder that the driver and all executors share."""

    def __init__(self, folder: str):
        uri = folder if urlparse(folder).scheme else f"file://{folder}"
        self.files, self.root = fs.FileSystem.from_uri(uri)

    def read(self, name: str) -> bytes:
        with self.files.open_input_stream(f"{self.root}/{name}") as data:
            return data.read()

    def write(self, name: str, data: bytes) -> None:
        path = f"{self.root}/{name}"
        self.files.create_dir(path.rsplit("/", 1)[0])
        with self.files.open_output_stream(path) as out:
            out.write(data)

    def replace(self, name: str, data: bytes) -> None:
        """Readers see the old content or the new one."""
        if isinstance(self.files, fs.LocalFileSystem):
            part = f"{name}.{uuid.uuid4().hex}"
            self.write(part, data)
            self.files.move(f"{self.root}/{part}", f"{self.root}/{name}")
        else:
            self.write(name, data)

    def exists(self, name: str) -> bool:
        return self.files.get_file_info(f"{self.root}/{name}").type != fs.FileType.NotFound

    def folders(self, name: str) -> list[str]:
        chosen = fs.FileSelector(f"{self.root}/{name}", allow_not_found=True)
        return [f.base_name for f in self.files.get_file_info(chosen) if f.type == fs.FileType.Directory]

    def drop(self, name: str) -> None:
        if self.exists(name):
            self.files.delete_dir(f"{self.root}/{name}")

    def manifest(self) -> dict:
        return json.loads(self.read(MANIFEST)) if self.exists(MANIFEST) else {"sets": {}}


@dataclass
class Written(WriterCommitMessage):
    """What a task reports: where its list is, and how much it holds."""

    attempt: str
    files: int
    examples: int


class SetWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.folder, self.name, self.overwrite = options["path"], options["set"], overwrite
        self.shapes = {k: [-1, *json.loads(options[f"{k}_shape"])] for k in ("inputs", "labels")}
        self.job = f"{self.name}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store = Store(self.folder)
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}"
        home, names, examples = f"data/{self.job}/{attempt}", [], 0
        for batch in iterator:
            for row in range(batch.num_rows):
                arrays = {}
                for part, shape in self.shapes.items():
                    flat = batch.column(part).slice(row, 1).flatten()
                    while pa.types.is_list(flat.type):
                        flat = flat.flatten()
                    arrays[part] = flat.to_numpy(zero_copy_only=False).astype("float32").reshape(shape)
                data = io.BytesIO()
                np.savez_compressed(data, **arrays)
                number = batch.column("batch_id")[row].as_py()
                store.write(f"{home}/{number}.npz", data.getvalue())
                names.append(number)
                examples += len(arrays["inputs"])
        store.write(f"{home}/_list.json", json.dumps(names).encode())
        return Written(attempt, len(names), examples)

    def commit(self, messages: list[Written | None]) -> None:
        store, done = Store(self.folder), [m for m in messages if m is not None]
        manifest = store.manifest()
        before = list(manifest["sets"].values()) if self.overwrite else [manifest["sets"].get(self.name)]
        sets = {} if self.overwrite else manifest["sets"]
        sets[self.name] = {
            "job": self.job,
            "attempts": sorted(m.attempt for m in done if m.files),
            "files": sum(m.files for m in done),
            "examples": sum(m.examples for m in done),
            "shapes": self.shapes,
        }
        store.replace(MANIFEST, json.dumps({"sets": sets}, indent=1).encode())
        # From here on nothing reads what the set held before, nor the attempts that lost.
        accepted = {m.attempt for m in done}
        for attempt in store.folders(f"data/{self.job}"):
            if attempt not in accepted:
                store.drop(f"data/{self.job}/{attempt}")
        for old in before:
            if old:
                store.drop(f"data/{old['job']}")

    def abort(self, messages: list[Written | None]) -> None:
        Store(self.folder).drop(f"data/{self.job}")


@dataclass
class Listed(InputPartition):
    home: str


class SetReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.name = options["path"], options.get("set")

    def partitions(self) -> list[Listed]:
        sets = Store(self.folder).manifest()["sets"]
        if self.name is not None and self.name not in sets:
            raise FileNotFoundError(f"no set {self.name!r} in {self.folder}")
        named = sets if self.name is None else {self.name: sets[self.name]}
        homes = [f"data/{s['job']}/{a}" for s in named.values() for a in s["attempts"]]
        return [Listed(home) for home in homes] or [Listed("")]

    def read(self, partition: Listed) -> Iterator[pa.RecordBatch]:
        if not partition.home:
            return
        store = Store(self.folder)
        for number in json.loads(store.read(f"{partition.home}/_list.json")):
            with np.load(io.BytesIO(store.read(f"{partition.home}/{number}.npz"))) as arrays:
                flat = {k: arrays[k].ravel() for k in ("inputs", "labels")}
                count = len(arrays["inputs"])
            columns = [[number], [count], [flat["inputs"]], [flat["labels"]]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


class TrainingSet(DataSource):
    @classmethod
    def name(cls) -> str:
        return "training_set"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> SetWriter:
        return SetWriter(self.options, overwrite)

    def reader(self, schema) -> SetReader:
        return SetReader(self.options)


def write_set(
    batched: DataFrame,
    folder: str,
    inputs_shape: Sequence[int],
    labels_shape: Sequence[int],
    name: str = "all",
    replace_others: bool = False,
) -> dict:
    """Write batches (batch_id, inputs, labels) as the set ``name`` and return its manifest entry.

    A batch becomes one file with arrays of shape (examples, *shape). The set appears as a whole or
    not at all; an earlier set of that name goes, and with ``replace_others`` all others too.
    """
    if not re.fullmatch(r"[A-Za-z0-9_]+", name):
        raise ValueError(f"not a name of a set: {name!r}")
    spark = batched.sparkSession
    spark.dataSource.register(TrainingSet)
    options = {"inputs_shape": json.dumps(list(inputs_shape)), "labels_shape": json.dumps(list(labels_shape)), "set": name}
    rows = batched.selectExpr("cast(batch_id as bigint) as batch_id", "inputs", "labels")
    mode = "overwrite" if replace_others else "append"
    rows.write.format("training_set").mode(mode).options(**options).save(folder)
    return Store(folder).manifest()["sets"][name]


def read_set(spark: SparkSession, folder: str, name: str | None = None) -> DataFrame:
    """(batch_id, n_examples, inputs, labels), arrays flat, of one set or of all of a folder."""
    spark.dataSource.register(TrainingSet)
    reader = spark.read.format("training_set")
    return (reader if name is None else reader.option("set", name)).load(folder)
