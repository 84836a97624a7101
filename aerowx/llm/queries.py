"""The operators as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import licenses
from .digest_index import exact_dedup
from .embed_dedup import embed_dedup
from .html_extract import extract_main_text
from .language import predict_language
from .licenses import license_lookup
from .lm import lm_score
from .mixing import mix
from .ngram_join import ngram_join
from .packing import pack
from .phrases import collocations
from .repair import damaged, repair
from .repair_sql import REPAIR_SQL
from .shared import LOWER, UPPER, table
from .suffix_dedup import repeated_spans
from .toxicity import toxicity

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_html_text(spark, sf_dir):
    return extract_main_text(table(spark, sf_dir, "pages"))


def op2_embedding_dedup(spark, sf_dir):
    return embed_dedup(table(spark, sf_dir, "embeddings"), 0.98)


def op3_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_ngram_join(spark, sf_dir):
    return ngram_join(table(spark, sf_dir, "documents"), size=4, percent=85)


def op5_packing(spark, sf_dir):
    return pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_suffix_dedup(spark, sf_dir):
    return repeated_spans(table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_lm_score(spark, sf_dir):
    return lm_score(table(spark, sf_dir, "documents"))


def op9_license_lookup(spark, sf_dir):
    return license_lookup(table(spark, sf_dir, "documents"))


def op10_source_mix(spark, sf_dir):
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", F.col("copies"))


def op11_phrase_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


def op12_conversation_repair(spark, sf_dir):
    return repair(damaged(table(spark, sf_dir, "conversations")))


def op13_language_id(spark, sf_dir):
    return predict_language(table(spark, sf_dir, "documents"), PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_html_text,
        op2_embedding_dedup,
        op3_toxicity,
        op4_ngram_join,
        op5_packing,
        op6_suffix_dedup,
        op7_exact_dedup,
        op8_lm_score,
        op9_license_lookup,
        op10_source_mix,
        op11_phrase_collocations,
        op12_conversation_repair,
        op13_language_id,
    )
}

_WORDS = (
    f"SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
    "'[^\\x20\\x09-\\x0D]+') AS w FROM documents"
)
_REACH = """
    reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)"""


def _known_values() -> str:
    rows = ", ".join(f"('{k}', '" + v.replace("'", "''") + "')" for k, v in licenses.known_rows(licenses.KNOWN))
    return f"(VALUES {rows}) AS k(license_id, body)"


ORACLE = {
    "op2_embedding_dedup": f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
n AS (
    SELECT *, sqrt(list_dot_product(e, e)) AS size FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL
      AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM n x JOIN n y ON x.label = y.label AND x.vec_id <> y.vec_id
    WHERE list_dot_product(x.e, y.e) / (x.size * y.size) >= 0.98),{_REACH},
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
d AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(d.n, 0) AS n_links, least(vec_id, coalesce(c.low, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(c.low, vec_id)) AS kept
FROM v LEFT JOIN c ON c.a = vec_id LEFT JOIN d ON d.a = vec_id""",
    "op4_ngram_join": f"""
WITH RECURSIVE words AS ({_WORDS}),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ') || '/' || len(w)]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words),
tokens AS (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS t FROM sets),
common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n, any_value(x.n) AS na, any_value(y.n) AS nb
    FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id <> y.doc_id
     AND 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * n >= 85 * (na + nb - n)),{_REACH},
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(c.low, doc_id)) AS component_id
FROM sets LEFT JOIN c ON c.a = doc_id""",
    "op6_suffix_dedup": f"""
WITH words AS ({_WORDS}),
windows AS (
    SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM words WHERE len(w) >= 50),
keys AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k FROM windows),
shared AS (
    SELECT k, min(doc_id) AS low, max(doc_id) AS high FROM keys GROUP BY k HAVING min(doc_id) <> max(doc_id)),
hits AS (SELECT doc_id, i - 1 AS i, low, high FROM keys JOIN shared USING (k)),
marked AS (
    SELECT *, CASE WHEN i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 1 ELSE 0 END AS fresh FROM hits),
parts AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS part FROM marked),
spans AS (
    SELECT doc_id, min(i) AS start_word, max(i) + 50 - min(i) AS n_words, min(low) AS low, max(high) AS high
    FROM parts GROUP BY doc_id, part)
SELECT doc_id, start_word, n_words, CASE WHEN low <> doc_id THEN low ELSE high END AS other_doc_id,
       low AS first_doc_id FROM spans""",
    "op7_exact_dedup": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
    "op12_conversation_repair": REPAIR_SQL,
    "op11_phrase_collocations": f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
sized AS (SELECT lang, w, unnest(range(1, 6)) AS m FROM words),
placed AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM sized),
known AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f FROM placed
    GROUP BY 1, 2, 3 HAVING count(*) >= 100),
candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM known WHERE m >= 2),
cuts AS (
    SELECT lang, phrase, a, m, unnest(range(1, m)) AS k, w FROM candidates),
scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r, n,
           (1000::HUGEINT * c.a * n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN totals USING (lang)
    JOIN known x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
    JOIN known y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, w, m, a, unnest(range(2, m)) AS s FROM candidates WHERE m >= 3),
starts AS (SELECT lang, w, a, s, unnest(range(1, m - s + 2)) AS i FROM inside),
longer AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS most FROM starts GROUP BY 1, 2)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM lowest LEFT JOIN longer USING (lang, phrase) WHERE most IS NULL OR 100 * most < 100 * a
QUALIFY rank <= 2000""",
    "op9_license_lookup": f"""
WITH known AS (
    SELECT sha256(f) AS canonical_sha256, min(license_id) AS license_id FROM (
        SELECT license_id, {licenses.canonical_sql('body')} AS f FROM {_known_values()}) WHERE f <> '' GROUP BY 1)
SELECT doc_id, canonical_sha256, license_id FROM (
    SELECT doc_id, sha256({licenses.canonical_sql('text')}) AS canonical_sha256 FROM documents)
LEFT JOIN known USING (canonical_sha256)""",
}
