"""Appends that can be repeated: a table of unique keys with a ledger of the batches in it.

    folder/rows                    the rows, by attempt, bucketed and sorted by key
    folder/ledger                  a line per batch: the attempt that counts, and its rows

A batch is written as an attempt of its own, which nobody sees until one line names it. So a
job that dies leaves the table as it was, and a batch that comes again gets its first answer.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import new_rows

BUCKETS = 64
ATTEMPT = "_attempt"
LEDGER = "batch string, attempt string, rows bigint"


class Ledger:
    """A table ``name`` with a key once, kept in ``folder``, which all executors share.

    One writer at a time. ``buckets`` is fixed when the table is made: choose it so that a bucket
    of the full table is some hundred megabytes. ``prefer`` names the columns whose smallest
    values decide which row of a key a batch adds.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        folder: str,
        keys: Sequence[str],
        prefer: Sequence[str] | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark, self.name, self.folder = spark, name, folder.rstrip("/")
        self.keys, self.prefer, self.buckets = list(keys), prefer, buckets

    def _log(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").json(f"{self.folder}/ledger")

    def entries(self) -> DataFrame:
        """(batch, attempt, rows) of every batch in the table."""
        return self.spark.read.schema(LEDGER).json(f"{self.folder}/ledger")

    def entry(self, batch: str):
        """What the ledger says of a batch, or None."""
        return self.entries().where(F.col("batch") == batch).first()

    def _create(self, like: DataFrame) -> None:
        if not self.spark.catalog.tableExists(self.name):
            self._log(self.spark.createDataFrame([], LEDGER))
            self._write(like.limit(0).withColumn(ATTEMPT, F.lit("")))

    def _write(self, rows: DataFrame) -> None:
        # Rows meet by key here as they will in the buckets, so each bucket is one file of an attempt.
        writer = rows.repartition(self.buckets, *self.keys).write.format("parquet").partitionBy(ATTEMPT)
        writer = writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        writer.option("path", f"{self.folder}/rows").mode("append").saveAsTable(self.name)

    def rows(self) -> DataFrame:
        """The rows of all batches in the ledger; only their folders are read."""
        known = [r["attempt"] for r in self.entries().select("attempt").collect()]
        return self.spark.table(self.name).where(F.col(ATTEMPT).isin(known)).drop(ATTEMPT)

    def rows_of(self, batch: str) -> DataFrame:
        """The rows that a batch added."""
        entry = self.entry(batch)
        if entry is None:
            raise KeyError(f"not in the ledger: {batch!r}")
        return self.spark.table(self.name).where(F.col(ATTEMPT) == entry["attempt"]).drop(ATTEMPT)

    def append(self, incoming: DataFrame, batch: str, **bounds) -> DataFrame:
        """Add the rows whose key is new, one per key, and return them.

        A batch that is in the ledger is not looked at again: its rows of then come back. Rows
        with a NULL key are always new. Few incoming keys are broadcast; many meet the stored
        ones bucket by bucket, which are neither shuffled nor sorted as long as a bucket has one file.
        """
        self._create(incoming)
        if self.entry(batch) is not None:
            return self.rows_of(batch)
        attempt = uuid.uuid4().hex
        fresh = new_rows(incoming, self.rows(), self.keys, self.prefer, **bounds)
        self._write(fresh.withColumn(ATTEMPT, F.lit(attempt)))
        added = self.spark.table(self.name).where(F.col(ATTEMPT) == attempt).count()
        line = (F.lit(batch), F.lit(attempt), F.lit(added).cast("long"))
        self._log(self.spark.range(1).select(*[c.alias(n) for c, n in zip(line, ("batch", "attempt", "rows"))]))
        return self.rows_of(batch)
