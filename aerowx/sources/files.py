"""File scans. A folder is one scan with the file's path as a column, however many
files it holds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import contracts as C
from ..functions.text import path_part
from ..functions.times import compose_date, parse_date


def parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def with_file(df: DataFrame) -> DataFrame:
    """Add ``file_path`` and ``file_name`` of the file a row came from."""
    return df.select("*", "_metadata.file_path", "_metadata.file_name")


def monthly_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType = C.STAGING,
    pattern: str = C.MONTHLY_FILE,
) -> DataFrame:
    """All ``{CODE}_{yyyy-M}.parquet`` files of a folder, with ``airport_code``,
    ``year_month`` and ``file_path``.

    Both parts are NULL where the name does not match. A column that a file lacks is
    NULL. An empty folder gives an empty table with these columns.
    """
    rows = (
        spark.read.schema(schema)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .parquet(folder)
    )
    path = F.col("_metadata.file_path")
    return rows.select(
        "*",
        path.alias("file_path"),
        path_part(path, pattern, 1).alias("airport_code"),
        path_part(path, pattern, 2).alias("year_month"),
    )


def dated(rows: DataFrame, day: str = "Date") -> DataFrame:
    """Replace the day of the month by the full date."""
    return rows.withColumn(day, parse_date(compose_date("year_month", day)))


def json_documents(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, multiline: bool = True
) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("multiLine", str(multiline).lower())
        .json([path] if isinstance(path, str) else list(path))
    )


def parse_documents(texts: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """JSON texts in a column to typed columns; the text column is dropped."""
    return (
        texts.withColumn("_doc", F.from_json(column, schema))
        .select(*[c for c in texts.columns if c != column], "_doc.*")
    )


def unwrap_airports(pages: DataFrame) -> DataFrame:
    """Landed airport pages to one row per record, under the ``airport_code`` name."""
    records = pages.select(F.explode("results").alias("r")).select("r.*")
    code = F.coalesce("column_1", "airport_code")
    return records.withColumn("airport_code", code).drop("column_1")


def typed_rows(
    spark: SparkSession, rows: Sequence[dict | tuple], schema: T.StructType
) -> DataFrame:
    """A short list of rows, which may be empty, under a fixed schema."""
    return spark.createDataFrame(list(rows), schema)
