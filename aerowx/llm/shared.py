"""What several operators need: reading tables, folds, word counts, shared storage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable

#: Upper and lower case of the only letters that are folded (fixed values).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: What counts as a word (fixed value).
WORD = r"[^\x20\x09-\x0D]+"


def _ship_package(spark: SparkSession) -> None:
    """Send the package to the executors unless they find it by themselves, once a session."""
    root = Path(__file__).resolve().parents[2]
    known = {Path(p).resolve() for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p}
    context = spark.sparkContext
    if root in known or getattr(context, "_aerowx_shipped", False):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/aerowx", "zip", root, "aerowx")
    context.addPyFile(archive)
    context._aerowx_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL ids fall into fold -1."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(folds), F.lit(-1))


def id_text(name: str) -> Column:
    """An id as text: pandas holds numbers beside a NULL as doubles, which rounds large ones."""
    return F.col(name).cast("long").cast("string")


def word_count(text: Column) -> Column:
    """Words of a whole text as a bigint; NULL has none."""
    found = F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1)))
    return found.cast("bigint")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors share."""
    if spark.sparkContext.getCheckpointDir() is None:
        durable(spark.range(1))
    root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    For what is wide and read more than once; narrow tables use ``durable``.
    """
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
