"""The pipeline's stages against what they may drop, and the registered queries."""

from __future__ import annotations

import corpus_pipeline
from aerowx.llm.queries import ORACLE, QUERIES
from aerowx.llm.shared import written

FOLDER = "/root/testdata/sf0.001"


def test_stages_drop_only_what_they_name(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    texts = [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, FOLDER), name)
        assert docs.columns == columns
        counts.append(docs.count())
        texts.append(docs)
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = {r.doc_id for r in texts[0].collect()} - {r.doc_id for r in texts[1].collect()}
    assert all(labels.get(i, 1) == 1 for i in gone)
    before, after = ({r.text for r in texts[k].collect()} for k in (1, 2))
    assert before == after and counts[2] == len(after)
    assert counts[3] <= counts[2]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert pieces.where("start = 0").count() == counts[4]


def test_queries_are_named_by_operator():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{k}" for k in range(1, 14)]
    assert set(ORACLE) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None


def test_exact_copies_leave_one_row_of_each_text(spark):
    rows = [
        (1, "alpha", "en", "a", 1), (1, "alpha", "en", "a", 1), (1, "alpha", "en", "b", 1), (None, "beta", "en", "a", 1),
        (None, "beta", "en", "a", 1), (2, "gamma", "en", "a", 1), (3, "gamma", None, "a", 1), (3, "delta", "en", "a", 1),
        (4, None, "en", "a", 1), (5, "", "en", "a", 1), (2, "delta", "en", "a", 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_copies(spark, docs, FOLDER)
    assert kept.columns == docs.columns
    found = sorted((tuple(r)[:2] for r in kept.collect()), key=str)
    assert found == sorted([(1, "alpha"), (None, "beta"), (3, "gamma"), (3, "delta"), (5, "")], key=str)
    assert corpus_pipeline.drop_copies(spark, docs.limit(0), FOLDER).count() == 0
