"""A corpus from raw documents to packed training sequences, stage by stage.

Every stage takes (spark, docs, folder of tables) and works on all rows it is given; ``run``
writes what a stage returns as Parquet to the shared folder and gives that to the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerowx.llm.digest_index import exact_dedup
from aerowx.llm.mixing import mixed_rows
from aerowx.llm.ngram_join import ngram_join
from aerowx.llm.packing import pack
from aerowx.llm.queries import TOKENIZER
from aerowx.llm.shared import table, written
from aerowx.llm.toxicity import toxicity
from aerowx.operators.sampling import first_per_key


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is listed, rows without an id if NULL is; columns as they were."""
    listed = ids.select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(listed, docs["doc_id"].eqNullSafe(listed["_id"]), "left_semi")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text is not predicted toxic. Ids decide for all rows that share them."""
    scored = toxicity(docs, table(spark, sf_dir, "labels"))
    rejected = scored.where("predicted = 1").select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(rejected, docs["doc_id"].eqNullSafe(rejected["_id"]), "left_anti")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row: with the largest id, of rows that share it the smallest by the other columns."""
    kept = exact_dedup(docs).where("kept").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("_rows"))
    kept = kept.select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"), "_rows")
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    same = (digest == kept["_sha"]) & docs["doc_id"].eqNullSafe(kept["_id"])
    found = docs.join(kept, same).select(*docs.columns, "_sha", "_rows")
    # Only rows that repeat are brought together, and shrink to one in each task first.
    once = found.where("_rows = 1").select(*docs.columns)
    repeated = first_per_key(found.where("_rows > 1"), ["_sha"]).select(*docs.columns)
    return once.unionByName(repeated)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a Jaccard of 0.8 or more, the smallest id."""
    joined = ngram_join(docs, size=5, percent=80)
    return _only(docs, joined.where("component_id <=> doc_id").select("doc_id"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_rows(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 2048 ids."""
    return pack(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL expresses neither the classifier nor the packing; tests compare stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
