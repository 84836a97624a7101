"""Session helpers: settings for tests and benches, and durable cut points."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def local_session(
    cpus: int | str = 8,
    partitions: int = 8,
    memory: str = "8g",
    settings: Mapping[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("aerowx")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # The test tables are small; at the default of 1 MB one core would do most of the work.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config(map=dict(settings or {}))
        .getOrCreate()
    )


def _use_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="aerowx-checkpoint-")
    context.setCheckpointDir(folder)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back from there.

    Used where a result is read more than once and must not change in between:
    the copy outlives lost executors, and its partitions stay as they are.
    """
    _use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    _use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir().rstrip('/')}/{name}-{uuid.uuid4().hex}"
