"""Language prediction: sums over segmentations by hand, held-out accuracy, edges."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from aerowx.llm.language import LIFT, UNIT, Lattice, Model, Pieces, predict_language, read_pieces, units_of

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, held_out string, unit long, n long, score string"


def ways(word, sizes):
    if not word:
        return [[]]
    return [[p, *rest] for p in sizes if word.startswith(p) for rest in ways(word[len(p) :], sizes)]


@pytest.fixture(scope="module")
def pieces():
    return read_pieces(VOCABULARY)


def test_forward_and_backward_sum_all_segmentations():
    known = [b"a", b"b", b" ", b"ab", b"aba", b" a", b"ba", b"bab"]
    p = np.array([0.2, 0.1, 0.05, 0.2, 0.1, 0.15, 0.1, 0.1])
    table = Pieces(known)
    units = [b" abab", b"b", b" bababa"]
    lattice = Lattice(units, table)
    weights = (p * np.exp(LIFT * table.sizes))[lattice.piece]
    alpha, beta, logs = lattice.forward(weights), lattice.backward(weights), lattice.log_sums(weights)
    for k, unit in enumerate(units):
        every = [math.prod(p[known.index(x)] for x in way) for way in ways(unit, known)]
        assert math.isclose(logs[k], math.log(sum(every)), rel_tol=1e-9)
        assert math.isclose(alpha[lattice.last[k]], beta[lattice.first[k]], rel_tol=1e-9)


def test_every_byte_stands_in_a_piece_and_a_long_word_loses_none(pieces):
    table = Pieces(pieces)
    word = bytes(c for c in range(256) if c not in b" \t\n\v\f\r") * 3
    assert b"".join(units_of(word)) == b" " + word and max(map(len, units_of(word))) == UNIT
    model = Model(["x"], np.zeros(1), table, np.full((len(pieces), 1), 1e-7) * np.exp(LIFT * table.sizes)[:, None])
    assert np.isfinite(model.word_scores([word, b"the" * 400])).all()
    found = {}
    data = np.frombuffer(b" the", np.uint8)
    for start, k in zip(*table.matches(data, np.full(4, 4))):
        found[int(start), pieces[k]] = True
    assert set(found) == {(i, p) for p in pieces for i in range(4) if b" the"[i:].startswith(p)}


def words_of(lang, rng, n):
    parts = {"aa": ["ka", "lo", "mi", "tu"], "bb": ["sch", "ein", "ung", "er"], "cc": ["ção", "eira", "ões", "lh"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def test_held_out_texts_and_the_edges(spark):
    rng = random.Random(2)
    rows = []
    for k in range(400):
        lang = rng.choice(["aa", "aa", "aa", "bb", "cc"])
        rows.append((k, words_of(lang, rng, rng.randint(3, 30)), lang, "s", "h", 1, 2, "x"))
    odd = [
        (None, words_of("bb", rng, 20), None), (2**60 + 1, "", "aa"), (2**60 + 3, None, "bb"), (5000, "12 345 !?", "cc"),
        (5001, words_of("cc", rng, 40_000), None), (5002, "lo" * 100_000, None), (5002, "lo" * 100_000, None),
    ]
    rows += [(*r, None, None, None, None, None) for r in odd]
    got = predict_language(spark.createDataFrame(rows, DOCS).coalesce(1), VOCABULARY).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    truth = {r[0]: r[2] for r in rows[:400]}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 50 and sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.98 * len(held)
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[2**60 + 1] == by_id[2**60 + 3] == by_id[5000] == ("und", 0.0)
    assert by_id[None][0] == "bb" and by_id[5001][0] == "cc" and by_id[5002][0] == "aa"
    again = predict_language(spark.createDataFrame(rows, DOCS).coalesce(1), VOCABULARY).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_nothing_to_learn_from(spark):
    assert predict_language(spark.createDataFrame([], DOCS), VOCABULARY).count() == 0
    lone = spark.createDataFrame([(1, "some text", None, None, None, None, None, None)], DOCS)
    assert [(r.lang_pred, r.score) for r in predict_language(lone, VOCABULARY).collect()] == [("und", 0.0)]
