"""Exact de-duplication with a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest, one row per distinct text. New
texts meet it in a sort-merge anti-join that reads the index without shuffling or sorting
it, and the digests it lacks are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import durable
from .shared import shared_folder

BUCKETS = 64
#: A digest with more rows than this share of a batch is looked up by a broadcast; there
#: are at most 1 / HOT_SHARE of them, whatever the size of the batch.
HOT_SHARE = 1 / 2000


def text_digest(text: Column) -> Column:
    """sha256 of the text in UTF-8 as lowercase hex; NULL counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


class DigestIndex:
    """Digests of all texts seen so far: (digest, keep_id, first_batch).

    ``buckets`` is fixed when the table is made: choose it so that one bucket of the full
    index is some hundred megabytes. The folder must be shared by all executors.
    """

    def __init__(self, spark: SparkSession, name: str, folder: str, buckets: int = BUCKETS):
        self.spark, self.name, self.folder, self.buckets = spark, name, folder, buckets

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def _append(self, rows: DataFrame) -> None:
        writer = rows.repartition(self.buckets, "digest").write.format("parquet")
        writer = writer.bucketBy(self.buckets, "digest").sortBy("digest").option("path", self.folder)
        writer.mode("append").saveAsTable(self.name)

    def create(self) -> None:
        """Make the table, empty, unless it is there."""
        if not self.exists():
            self._append(self.spark.createDataFrame([], "digest string, keep_id long, first_batch string"))

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (one per digest) whose digest the index lacks."""
        return groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch: str | None = None) -> DataFrame:
        """De-duplicate a batch against itself and the index, and append what is new.

        Returns one row per input row: id, keep_id, group_size, kept, text_sha256. Of equal
        texts in the batch the row with the largest id stays, unless an earlier batch had
        the text: then that batch's row stays and all of these go. NULL texts count as
        empty. NULL ids lose against any other; rows alike in id and text all name the same
        keep_id and are all kept if it is theirs. An empty batch adds nothing.

        Name the ``batch`` so that it can be repeated: a job that dies after the append and runs
        again under that name finds its own digests in the index and gives the first answer.
        """
        batch = batch or uuid.uuid4().hex
        self.create()
        rows = docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))
        groups = durable(
            rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        )
        fresh = self.unseen(groups).select("digest", "keep_id", F.lit(batch).alias("first_batch"))
        self._append(fresh)
        # What each digest of this batch resolves to, read back from the index.
        settled = durable(
            groups.withColumnRenamed("keep_id", "batch_keep").join(self.table().hint("merge"), "digest")
        )
        return self._resolve(rows, settled, batch)

    def _resolve(self, rows: DataFrame, settled: DataFrame, batch: str) -> DataFrame:
        total = settled.agg(F.sum("group_size")).first()[0] or 0
        least = max(2, int(total * HOT_SHARE))
        hot, rest = settled.where(F.col("group_size") >= least), settled.where(F.col("group_size") < least)
        held = rows.join(F.broadcast(hot.select("digest", F.lit(True).alias("_hot"))), "digest", "left")
        single = held.where("_hot").drop("_hot").join(F.broadcast(hot), "digest")
        spread = held.where("_hot IS NULL").drop("_hot").join(rest.hint("merge"), "digest")
        own = F.col("first_batch") == F.lit(batch)
        return single.unionByName(spread).select(
            "doc_id",
            "keep_id",
            "group_size",
            (own & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    index: DigestIndex | None = None,
    batch: str | None = None,
) -> DataFrame:
    """De-duplicate one table against a lasting index, or a new and empty one; see ``DigestIndex.add``."""
    if index is None:
        spark = docs.sparkSession
        name = f"digests_{uuid.uuid4().hex}"
        index = DigestIndex(spark, name, shared_folder(spark, name), buckets)
    return index.add(docs, id_col, text_col, batch)
