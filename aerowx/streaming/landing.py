"""Monthly files appended as they land: the same scan, conform step and append, as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import contracts as C
from ..functions.text import path_part
from ..plans.historic import historic
from ..sinks import new_rows, write_partitioned

KEYS = ["airport_code", "date_recorded"]


def same_months(incoming: DataFrame, table_path: str) -> DataFrame:
    """The table's rows of the months that ``incoming`` brings.

    The months, one text per calendar month, go into the plan as literals, so that the
    scan lists and reads their folders only.
    """
    months = [r["year_month"] for r in incoming.select("year_month").distinct().collect()]
    existing = incoming.sparkSession.read.schema(incoming.schema).parquet(table_path)
    return existing.where(F.col("year_month").isin(sorted(months)))


def append_landed(
    spark: SparkSession, folder: str, table_path: str, rejects_path: str, checkpoint: str
) -> StreamingQuery:
    """Append every file not seen yet to the monthly parquet table, then stop.

    A repeated delivery adds nothing. Each batch compares only with the months it
    brings, which are folders of the table. Rejected rows go to a folder per batch,
    which a batch that runs again writes anew. Runs again from its checkpoint.
    """
    path = F.col("_metadata.file_path")
    staged = (
        spark.readStream.schema(C.STAGING)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .parquet(folder)
        .select(
            "*",
            path_part(path, C.MONTHLY_FILE, 1).alias("airport_code"),
            path_part(path, C.MONTHLY_FILE, 2).alias("year_month"),
        )
    )

    def append(batch: DataFrame, number: int) -> None:
        # Rejects, months, look-up and write all read the batch.
        batch.persist()
        try:
            rows, rejected = historic(batch)
            rejected.write.mode("overwrite").parquet(f"{rejects_path}/batch={number}")
            month = F.date_format("date_recorded", "yyyy-MM")
            incoming = rows.withColumn("year_month", month)
            there = same_months(incoming, table_path)
            write_partitioned(new_rows(incoming, there, KEYS), table_path, ["year_month"], "append")
        finally:
            batch.unpersist()

    spark.createDataFrame([], C.HISTORIC).withColumn(
        "year_month", F.lit("").cast("string")
    ).write.mode("append").partitionBy("year_month").parquet(table_path)
    return (
        staged.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
