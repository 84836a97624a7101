"""Large ids beside a NULL, and rows repeated in all columns, through every operator."""

from __future__ import annotations

import public_tokenizers
import pytest

from aerowx.llm.digest_index import exact_dedup
from aerowx.llm.embed_dedup import embed_dedup
from aerowx.llm.html_extract import extract_main_text
from aerowx.llm.language import predict_language
from aerowx.llm.licenses import license_lookup
from aerowx.llm.lm import lm_score
from aerowx.llm.mixing import mix
from aerowx.llm.ngram_join import ngram_join
from aerowx.llm.packing import pack
from aerowx.llm.toxicity import toxicity

BIG, NEXT = 2**60 + 1, 2**60 + 3
IDS = [BIG, NEXT, None, 5, 5]


def documents(spark):
    texts = ["one two three four five six", "seven eight nine ten", "some text", "again the same", "again the same"]
    rows = [(i, t, "en", "s", None) for i, t in zip(IDS, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1)


OPERATORS = {
    "toxicity": lambda docs: toxicity(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")),
    "ngram": ngram_join,
    "packing": lambda docs: pack(docs, public_tokenizers.path("byte_bpe_50k.json")),
    "exact": exact_dedup,
    "lm": lm_score,
    "licenses": license_lookup,
    "mix": mix,
    "language": lambda docs: predict_language(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken")),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_document_ids_stay_as_they_are(spark, name):
    found = OPERATORS[name](documents(spark))
    assert dict(found.dtypes)["doc_id"] == "bigint"
    assert sorted((r["doc_id"] for r in found.collect()), key=str) == sorted(IDS, key=str)


def test_vector_ids(spark):
    rows = [(i, 1, [1.0, float(k)]) for k, i in enumerate(IDS[:4])] + [(5, 1, [1.0, 3.0])]
    found = embed_dedup(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").coalesce(1), 0.999999)
    got = sorted(((r.vec_id, r.component_id) for r in found.collect()), key=str)
    assert got == sorted(((i, i) for i in IDS), key=str)


def test_page_ids(spark):
    rows = [(i, f"https://h{k}.org/", f"<article><p>text {k}</p></article>") for k, i in enumerate(IDS[:4])]
    rows += [(5, "https://x.org", "<p>loose words here</p>"), (None, None, "<p>others there</p>")]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1))
    assert sorted((r.page_id for r in found.collect()), key=str) == sorted([*IDS, None], key=str)


def test_links_of_large_ids_hold_real_documents(spark):
    words = " ".join(f"w{k}" for k in range(40))
    ids = [2**61 + 2 * k + 1 for k in range(50)]
    rows = [(i, words if k % 2 else words + f" tail{k}", None) for k, i in enumerate(ids)] + [(None, words, 1)]
    found = ngram_join(spark.createDataFrame(rows, "doc_id long, text string, n long").coalesce(1))
    got = {(r.doc_id, r.component_id) for r in found.collect()}
    assert got == {(i, ids[0]) for i in ids} | {(None, ids[0])}
