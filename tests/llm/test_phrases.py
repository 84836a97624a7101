"""Phrase mining against a count by hand."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from aerowx.llm.phrases import Block, collocations, frequent_phrases, second_hashes

DOCS = "doc_id long, text string, lang string, phrase string, n long, f long, k long, words string"
LOW = {c: c + 32 for c in range(65, 91)}


def rows():
    rng = random.Random(3)
    words = ["A", "b", "ça", "d1", "e", "f"]
    texts = [
        (" ".join(rng.choice(words) + rng.choice(["", "", ".", "\t", "\n"]) for _ in range(rng.randint(0, 60))), rng.choice(["x", "y", None]))
        for _ in range(150)
    ]
    texts += [(None, "x"), ("", "q"), ("x" * 5000 + " " + "é" * 3000, "z"), ("a a a a a a", "x")] * 3
    return [(k // 2 or None, t, lang, "p", 1, 2, 3, "w") for k, (t, lang) in enumerate(texts)]


def counts(table):
    found = Counter()
    for row in table:
        lang = row[2] or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (row[1] or "").translate(LOW)):
            w = re.findall("[^\x20\x09]+", piece)
            found[lang, 0, ""] += len(w)
            for n in range(1, 6):
                for i in range(len(w) - n + 1):
                    found[lang, n, " ".join(w[i : i + n])] += 1
    return found


def expected(table, least, top):
    found, out = counts(table), {}
    known = {k: v for k, v in found.items() if v >= least and k[1] >= 1}
    for (lang, m, phrase), a in known.items():
        if m < 2:
            continue
        w, n = phrase.split(" "), found[lang, 0, ""]
        cuts = []
        for k in range(1, m):
            left, right = found[lang, k, " ".join(w[:k])], found[lang, m - k, " ".join(w[k:])]
            cuts.append((1000 * a * n // (left * right), k, left, right))
        inside = [
            f for (x, size, p), f in known.items() if x == lang and size > m and f" {phrase} " in f" {p} "
        ]
        if not inside or max(inside) < a:
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, phrase.encode(), left, right, n))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, n, -s)
        for lang, found in out.items()
        for i, (s, a, p, left, right, n) in enumerate(sorted(found)[:top])
    )


@pytest.mark.parametrize("least, bits, block", [(3, 64, 500), (4, 3, 800)])
def test_counts_are_exact_whatever_collides(spark, least, bits, block):
    table = rows()
    df = spark.createDataFrame(table, DOCS).repartition(3)
    found = frequent_phrases(df, least, 5, block_bytes=block, fingerprint_bits=bits)
    got = {(r.lang, r.n_words, r.phrase): r.f for r in found.collect()}
    assert got == {k: v for k, v in counts(table).items() if v and (v >= least or k[1] == 0)}


def test_collocations_follow_the_definition(spark):
    table = rows()
    got = collocations(spark.createDataFrame(table, DOCS), least=6, top=25)
    assert sorted(tuple(r) for r in got.collect()) == expected(table, 6, 25)


def test_an_empty_table_has_no_phrases(spark):
    got = collocations(spark.createDataFrame([], DOCS))
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and got.count() == 0


def test_words_that_only_share_a_hash_get_their_own_numbers():
    block = Block([b"one two one three", b"two"], ["x", "y"])
    block.words[:] = 7
    ids = block.word_ids().tolist()
    assert ids[0] == ids[2] and ids[1] == ids[4] and len(set(ids)) == 3


def test_second_hashes_cross_the_windows():
    long = b"w" * 200_000
    data = b" ".join([b"abc", long, b"abc", b"abd", b"v" * 300, b"v" * 300])
    starts, at = [], 0
    for word in data.split(b" "):
        starts.append(at)
        at += len(word) + 1
    block = Block([data], ["x"])
    found = second_hashes(block.data, block.starts, block.ends).tolist()
    assert block.starts.tolist() == starts
    assert found[0] == found[2] != found[3] and found[4] == found[5] and len(set(found)) == 4
