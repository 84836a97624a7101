"""Each operator against brute force on small tables, and its defined results at the edges."""

from __future__ import annotations

import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aerowx.llm import suffix_dedup
from aerowx.llm.components import components
from aerowx.llm.digest_index import DigestIndex, exact_dedup
from aerowx.llm.embed_dedup import embed_dedup
from aerowx.llm.html_extract import extract_main_text, page_blocks
from aerowx.llm.licenses import KNOWN, license_lookup
from aerowx.llm.lm import lm_score
from aerowx.llm.mixing import mix, mixed_rows
from aerowx.llm.ngram_join import linked as ngram_links
from aerowx.llm.ngram_join import ngram_join
from aerowx.llm.packing import Encoder, closest_fill, pack, plan
from aerowx.llm.shared import shared_folder
from aerowx.llm.suffix_dedup import repeated_spans, without_repeats
from aerowx.llm.toxicity import fit, toxicity
from aerowx.llm.words import hash_words, text_words

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, grp string, key string, size string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]


def documents(spark, pairs):
    rows = [(i, t, None, f"s{(i or 0) % 3}" if i != 7 else None, None, 5, "x", "y", "z") for i, t in pairs]
    return spark.createDataFrame(rows, DOCS)


def sentence(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


VOCABULARY = [f"w{k}" for k in range(400)] + ["Der", "d'été", "naïve", "日本", "x y"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    pairs = [(k, sentence(rng, rng.randint(1, 160))) for k in range(60)]
    passage = sentence(rng, 70)
    pairs += [(100 + k, sentence(rng, 30) + " " + passage + "\n" + sentence(rng, 20)) for k in range(4)]
    base = sentence(rng, 120).split(" ")
    for k in range(8):
        near = list(base)
        for _ in range(k):
            near[rng.randrange(len(near))] = "changed"
        pairs.append((200 + k, " ".join(near)))
    pairs += [(300, pairs[3][1]), (301, pairs[3][1]), (7, ""), (8, "  \t\n"), (9, None), (None, "no id here"), (None, None)]
    pairs += [(400, "one two"), (401, "ONE  two"), (402, "one two three"), (60, "x" * 300_000), (61, "y " * 50_000)]
    return pairs


def reachable(ids, links):
    up = {i: i for i in ids}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def test_words_equal_the_pattern_whatever_their_length():
    texts = ["", None, "a  B\tc\n", "x" * 200_000 + " Y", " 日本 é f ", "q " * 100_000, "\x00 \x1c z"]
    known = {}
    for text, hashes in zip(texts, text_words(texts)):
        assert len(hashes) == len(words(text))
        for word, h in zip(words(text), hashes.tolist()):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)
    data = "ab  Cd".encode()
    starts, ends, _ = hash_words(data)
    assert [data[a:b] for a, b in zip(starts, ends)] == [b"ab", b"Cd"]


def test_components_of_paths_stars_and_nothing(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(5, 5), (200, 201), (201, 202)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = reachable({x for e in edges for x in e}, edges)
    assert found == {k: v for k, v in want.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ngram_join_equals_all_pairs(spark, corpus):
    for size, percent in ((4, 85), (5, 80)):
        got = ngram_join(documents(spark, corpus), size, percent).collect()
        sets = []
        for i, t in corpus:
            w = words(t)
            sets.append((i, {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()))
        links = [
            (i, j)
            for a, (i, x) in enumerate(sets)
            for j, y in sets[:a]
            if x and y and None not in (i, j) and 100 * len(x & y) >= percent * len(x | y)
        ]
        low = reachable({i for i, _ in sets if i is not None}, links)
        want = sorted(((i, len(s), low.get(i)) for i, s in sets), key=repr)
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want


def test_ngram_join_of_crowded_tokens(spark):
    rng = random.Random(1)
    base = [f"b{k}" for k in range(40)]
    pairs = [(k, " ".join([*base[: 38 - k % 3], f"u{k}"])) for k in range(90)]
    pairs += [(1000 + k, " ".join(base[:6]) + " " + sentence(rng, 60)) for k in range(60)]
    got = {r.doc_id: r.component_id for r in ngram_join(documents(spark, pairs), 4, 85).collect()}
    assert {got[k] for k in range(90)} == {0}
    assert all(got[1000 + k] == 1000 + k for k in range(60))


def test_repeated_spans_equal_all_windows(spark, corpus):
    docs = documents(spark, corpus)
    spans = repeated_spans(docs)
    holders = defaultdict(set)
    tokens = [(i, words(t)) for i, t in corpus if i is not None]
    for i, w in tokens:
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    want = set()
    for i, w in tokens:
        covered = {x for k in range(len(w) - 49) if len(holders[tuple(w[k : k + 50])]) > 1 for x in range(k, k + 50)}
        want |= {(i, x) for x in covered}
    got = {(r.doc_id, r.start_word + k) for r in spans.collect() for k in range(r.n_words)}
    assert got == want and want
    cut = {r.doc_id: r.text for r in without_repeats(docs, spans).where("doc_id >= 100 AND doc_id < 104").collect()}
    assert len(words(cut[100])) == 120 and all(len(words(cut[k])) <= 52 for k in (101, 102, 103))


def covered_words(pairs):
    holders = defaultdict(set)
    tokens = [(i, words(t)) for i, t in pairs if i is not None]
    for i, w in tokens:
        for k in range(len(w) - 49):
            holders[tuple(w[k : k + 50])].add(i)
    hit = lambda w, k: len(holders[tuple(w[k : k + 50])]) > 1
    return {(i, x) for i, w in tokens for k in range(len(w) - 49) if hit(w, k) for x in range(k, k + 50)}


def test_repeated_spans_of_a_cut_gram(spark, corpus, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_ROWS", 3)
    rng = random.Random(12)
    line = sentence(rng, 30)
    near = [sentence(rng, 25) for _ in range(4)]
    # One frequent sentence in ever different text; some of it goes on alike on either side.
    pairs = [*corpus, *[(1000 + k, f"{sentence(rng, 60)} {line} {sentence(rng, 60)}") for k in range(60)]]
    pairs += [(2000 + k, f"{sentence(rng, 9)} {near[k % 4]} {line} {near[k % 3]} {sentence(rng, 9)}") for k in range(24)]
    got = repeated_spans(documents(spark, pairs)).collect()
    assert {(r.doc_id, r.start_word + k) for r in got for k in range(r.n_words)} == covered_words(pairs)
    assert {r.doc_id for r in got} >= set(range(2000, 2024))


def test_a_task_holds_a_bounded_part_of_a_gram():
    taken = []

    def batches():
        for k in range(20):
            taken.append(k)
            rows = np.random.default_rng(k).integers(1, 1 << 31, (1000, 92)).astype(np.uint32)
            ids = np.arange(1000) + 1000 * k
            yield pd.DataFrame({"gram": 7, "around": ids, "low": ids, "high": ids + 1, "words": [r.tobytes() for r in rows]})

    next(suffix_dedup._extend(50, 8)(batches()))
    assert len(taken) <= 5


def test_a_cut_gram_sends_each_window_once(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "MOST_ROWS", 50)
    same = np.random.default_rng(3).integers(1, 1 << 31, 92).astype(np.uint32)
    ids = np.arange(200)
    frame = pd.DataFrame({"gram": 7, "around": ids, "low": ids, "high": ids, "words": [same.tobytes()] * 200})
    out = pd.concat(suffix_dedup._extend(50, 8)(iter([frame])), ignore_index=True)
    windows = out[out["key"].notna()]
    # 200 rows with equal words: one row per window and piece, not one per row and window.
    assert len(windows) == len(windows.drop_duplicates(["piece", "key"])) <= 43 * out["piece"].nunique()
    assert out["piece"].nunique() <= 5 and (windows["first"] < windows["last"]).all()


def test_exact_dedup_and_a_second_batch(spark, corpus):
    rows = exact_dedup(documents(spark, corpus)).collect()
    by_text = defaultdict(list)
    for i, t in corpus:
        by_text[t or ""].append(i)
    assert len(rows) == len(corpus)
    for r in rows:
        group = next(g for t, g in by_text.items() if r.doc_id in g and r.group_size == len(g))
        assert r.keep_id == max((i for i in group if i is not None), default=None)
        assert r.kept == (r.doc_id == r.keep_id)
    index = DigestIndex(spark, "digests_of_two_batches", shared_folder(spark, "index"), 4)
    index.add(documents(spark, [(1, "a"), (2, "b")])).count()
    second = {r.doc_id: (r.keep_id, r.kept) for r in index.add(documents(spark, [(3, "a"), (4, "c"), (5, "c")])).collect()}
    assert second == {3: (1, False), 4: (5, False), 5: (5, True)}
    assert index.table().count() == 3


def test_a_batch_of_a_lasting_index_can_be_repeated(spark):
    index = DigestIndex(spark, "digests_of_repeated_batches", shared_folder(spark, "index"), 4)
    batches = {"one": documents(spark, [(1, "a"), (2, "b"), (3, "b")]), "two": documents(spark, [(9, "a"), (4, "c")])}
    first = {n: sorted(map(repr, exact_dedup(d, index=index, batch=n).collect())) for n, d in batches.items()}
    # Whatever was appended before a job died, the batch gets its first answer again.
    again = {n: sorted(map(repr, exact_dedup(d, index=index, batch=n).collect())) for n, d in batches.items()}
    assert again == first and index.table().count() == 3
    assert sum("kept=True" in r for rows in first.values() for r in rows) == 3


def test_embeddings_equal_all_pairs(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(240):
        v = rng.normal(size=16)
        if k % 3 == 0:
            v = rows[0][1] + rng.normal(size=16) * 0.12 if k else v
        rows.append((k, np.asarray(v), k % 2))
    odd = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 1), (903, list(rows[4][1]), None)]
    odd += [(904, [float("inf")] + [1.0] * 15, 0), (905, [1.0, None] + [0.0] * 14, 0), (906, [], 1), (907, [1.0, 2.0], 1)]
    odd += [(None, list(rows[0][1]), 0), (908, list(rows[6][1] * 1e200), 0), (908, list(rows[6][1] * 1e200), 0)]
    table = [(i, None if v is None else [None if x is None else float(x) for x in v], y) for i, v, y in rows + odd]
    given = spark.createDataFrame([(*r, "x") for r in table], "vec_id long, embedding array<double>, label int, dims string")
    got = embed_dedup(given, 0.98).collect()
    good = [(p, i, np.array(v, float), y) for p, (i, v, y) in enumerate(table) if i is not None and v and y is not None and None not in v]
    good = [(p, i, v / np.abs(v).max(), y) for p, i, v, y in good if np.isfinite(v).all() and v.any()]
    links = [
        (p, q, i, j)
        for p, i, v, y in good
        for q, j, u, z in good
        if p != q and y == z and len(u) == len(v) and v @ u / (np.linalg.norm(v) * np.linalg.norm(u)) >= 0.98
    ]
    degree = Counter(p for p, _, _, _ in links)
    low = reachable({i for i, _, _ in table if i is not None}, [(i, j) for _, _, i, j in links])
    want = sorted(((i, degree[p], low.get(i), low.get(i) == i) for p, (i, _, _) in enumerate(table)), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want and len(links) > 50


def test_lm_equals_brute_force(spark, corpus):
    got = {(r.doc_id, r.n_tokens): r for r in lm_score(documents(spark, corpus), backoff=7.0, block_bytes=4000).collect()}
    one, two, history = Counter(), Counter(), Counter()
    for i, t in corpus:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            w = [*words(t), "</s>"]
            one.update(w)
            two.update(zip(["<s>", *w], w))
            history.update(["<s>", *w[:-1]])
    total, distinct = sum(one.values()), len(one)
    for i, t in corpus:
        w = [*words(t), "</s>"]
        p = [(one[x] + 0.5) / (total + 0.5 * (distinct + 1)) for x in w]
        score = sum(math.log10((two[h, x] + 7 * q) / (history[h] + 7)) for h, x, q in zip(["<s>", *w], w, p))
        r = got[i, len(w)]
        assert r.train_tokens == total and r.n_known == sum(one[x] > 0 for x in w)
        assert r.base_score == pytest.approx(sum(map(math.log10, p))) and r.score == pytest.approx(score)
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 1)


def test_encoder_equals_the_tokenizer():
    rng = random.Random(3)
    theirs, ours = Tokenizer.from_file(TOKENIZER), Encoder(TOKENIZER)
    bits = ["a", "Word", " ", "  ", "\n", "\t ", "'ll", "é", "日", " ", " ", "12", "!?", "<|endoftext|>", "\x1c", "\r\n", " x"]
    for _ in range(400):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(ours.ids(text), "<u4").tolist() == theirs.encode(text, add_special_tokens=False).ids, text


def test_packing_round_trip(spark, corpus):
    theirs = Tokenizer.from_file(TOKENIZER)
    rows = pack(documents(spark, corpus), TOKENIZER, 256).collect()
    sequences, documents_ = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents_[r.doc_id, r.doc_tokens].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    for i, t in corpus:
        ids = [*theirs.encode(t or "", add_special_tokens=False).ids, 1]
        pieces = [r for r in documents_[i, len(ids)]]
        assert sum(r.length for r in pieces) == len(ids)
        for r in pieces:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert zlib.crc32(part) == r.ids_crc32
    padding = sum(256 - sum(n for _, n in p) for p in sequences.values())
    assert padding <= 2 * 256


def test_closest_fill_and_plan():
    rng = random.Random(5)
    for _ in range(60):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(4)}
        sums = {0}
        for length, n in counts.items():
            sums = {s + k * length for s in sums for k in range(n + 1)}
        used = closest_fill(counts, 50)
        assert all(n <= counts[k] for k, n in used.items())
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= 50)
        placed = Counter()
        for times, lengths in plan(counts, 50):
            assert sum(k * n for k, n in lengths.items()) <= 50
            placed.update({k: n * times for k, n in lengths.items()})
        assert placed == Counter(counts)


def test_mix_targets_and_copies(spark, corpus):
    # Without the one text that is longer than any target, which whole copies can't meet.
    docs = documents(spark, [(i, t) for i, t in corpus if i != 61])
    rows = mix(docs).collect()
    size, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r.size >= 0 and 0 <= r.taken <= 3 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    names = sorted(s for s in size if s is not None) + [None] * (None in size)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    want, free, left = {}, set(names), float(sum(size.values()))
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * size[s]}
        want |= {s: 3.0 * size[s] for s in full} or share
        left -= sum(3 * size[s] for s in full)
        free = free - full if full else set()
    assert all(target[s] == pytest.approx(want[s]) for s in names)
    assert all(abs(taken[s] - want[s]) <= 0.1 * want[s] + 60 for s in names)
    assert sorted(map(repr, rows)) == sorted(map(repr, mix(docs.repartition(5)).collect()))
    copies = Counter()
    for r in rows:
        copies[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in mixed_rows(docs).collect()) == +copies
    assert mixed_rows(docs).columns == docs.columns


def test_licences(spark):
    mit = KNOWN["MIT"]
    variants = [mit, mit.upper(), "Copyright (c) 2020 Some One\n" + mit, mit.replace(",", " ").replace("\n", "  \n")]
    rows = [(k, t) for k, t in enumerate(variants)] + [(10, mit + " and more"), (11, None), (12, ""), (13, "© x\n")]
    got = {r.doc_id: r for r in license_lookup(documents(spark, rows)).collect()}
    assert [got[k].license_id for k in range(4)] == ["MIT"] * 4
    assert [got[k].license_id for k in (10, 11, 12, 13)] == [None] * 4
    spelled = license_lookup(documents(spark, [(1, "the licence favours no organisation")]), {"x": "The license favours no organization."})
    assert spelled.first().license_id == "x"


ISC_AS_PUBLISHED = """The ISC License

# Copyright (c) Some One and Contributors

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR
ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN
ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR
IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""


def test_licences_as_published(spark):
    mit = KNOWN["MIT"].removeprefix("MIT License\n\n")
    wrapped = "\n".join(textwrap.wrap(KNOWN["ISC"], 60))
    bsd, apache = KNOWN["BSD-3-Clause"], KNOWN["Apache-2.0"]
    listed = [
        ("ISC", ISC_AS_PUBLISHED),
        ("ISC", " * Copyright 2011 A. Holder\n" + wrapped),
        ("MIT", "The MIT License (MIT)\n\n// Copyright (c) 2014 Jane\n// © 2015 Joe\n\n" + mit),
        ("MIT", "Copyright JS Foundation and other contributors, https://js.foundation/\n\n" + mit),
        ("BSD-3-Clause", "Copyright (c) 2009, A\nAll rights reserved.\n\n" + bsd.split("\n", 1)[1].replace("OWNER OR", "HOLDER OR")),
        ("BSD-2-Clause", "BSD 2-Clause License\n\n" + KNOWN["BSD-2-Clause"]),
        ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2011 Dominic Tarr")),
        ("Apache-2.0", "\n".join(textwrap.wrap(apache.split("   END OF TERMS")[0], 50))),
        *[(k, KNOWN[k]) for k in ("GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "Unlicense")],
        (None, ISC_AS_PUBLISHED.replace("copyright notice and this permission notice", "")),
        (None, bsd.replace("this list of conditions", "")),
    ]
    got = {r.doc_id: r.license_id for r in license_lookup(documents(spark, [(k, t) for k, (_, t) in enumerate(listed)])).collect()}
    assert [got[k] for k in range(len(listed))] == [name for name, _ in listed]


def test_toxicity_learns_and_ignores_groups(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for k in range(600):
        toxic = k % 4 == 0
        text = sentence(rng, 30) + (" idiotic" if toxic else "") + (" muslims" if toxic == (k % 8 < 4) else "")
        rows.append((k, text))
        labels.append((k, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "idiotic"), (1002, "idiotic " * 30_000)]
    tagged = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    got = toxicity(documents(spark, rows), tagged).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.predicted == int(r.doc_id % 4 == 0)
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert {r.predicted for r in got if r.doc_id in (1000, 1001)} == {0}
    none = toxicity(documents(spark, rows[:3]), tagged.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    # Feature 0 is a group, swapped for the absent feature 1; feature 2 tells the label.
    own, other, y = [[0, 2], [0], [2], []] * 20, [[1, 2], [1], None, None] * 20, [1, 0, 1, 0] * 20
    biased_y = [1, 1, 1, 0] * 20
    loose, held = (fit(own, other, biased_y, 3, 0.3, c) for c in (0.0, 5.0))
    assert abs(held[0] - held[1]) < 0.3 * abs(loose[0] - loose[1])
    assert fit(own, other, y, 3, 0.3, 1.0)[2] > 1


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body><header>Site</header>
<nav><a href=x>Menu</a></nav><div class="cookie-notice">We use cookies</div><script>var t="</p>";</script>
{body}<aside>Side</aside><section id="comments"><p>Reader says</p></section><form><p>Sign up</p></form>
<footer>&copy; all rights</footer></body></html>"""


def test_pages_with_content_elements():
    inner = "<h1>A &amp; B</h1><p class=x>One  <b>two</b>\n three<br>four<p>Five &lt;6&gt;</p><div class='ad'>Buy</div><ul><li>i<li>ii</ul>"
    want = ["A & B", "One two three four", "Five <6>", "i", "ii"]
    for open_, close in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>")):
        blocks = page_blocks(PAGE.format(body=open_ + inner + close))
        top = max(level for level, _ in blocks)
        assert [t for level, t in blocks if level == top] == want


def test_html_of_near_copies(spark):
    rng = random.Random(9)
    head, foot = "Welcome to our site which you should read every single day", "All the best links of the whole week are here"
    rows, want = [], {}
    for k in range(4):
        paragraphs = [" ".join(sentence(rng, 40).split()) for _ in range(3)]
        # The last page of each host stands there in 2 or 30 versions that differ in one word.
        for v in range([1, 2, 1, 30][k]):
            text = [*paragraphs, f"Seen by {v} readers up to this very day of the year"]
            page = 100 * k + v
            rows.append((page, f"https://h{k // 2}.org/{k}?page={v}", f"<div>{head}</div>" + "".join(f"<p>{t}</p>" for t in text) + f"<div>{foot}</div>"))
            want[page] = paragraphs
    got = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for page, paragraphs in want.items():
        assert got[page].split("\n")[:3] == paragraphs and head not in got[page] and foot not in got[page]


def test_html_by_host(spark):
    rng = random.Random(8)
    rows, want = [], {}
    for k in range(12):
        text = [sentence(rng, 20).replace(" ", " ") for _ in range(3)]
        body = "<div>Welcome to our site which you should read every single day</div>" + "".join(f"<p>{t}</p>" for t in text)
        rows.append((k, f"https://h{k % 2}.example.org/{k}", "<body>" + body + "<div>All the best links of the whole week are here</div>", 1))
        want[k] = "\n".join(text)
    rows.append((12, rows[4][1] + "?again", rows[4][2], 1))
    want[12] = want[4]
    rows += [(20, None, None, 1), (21, "x", "", 1), (22, "", "<p>unclosed <b>" + "z" * 200_000, 1), (None, None, "<p", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in extract_main_text(pages).collect()}
    assert {k: got[k].text for k in want} == want
    assert got[20].text == got[21].text == "" and got[20].n_chars == 0
    assert got[22].n_chars == len(got[22].text) == 200_009


@pytest.mark.parametrize("name", ["documents", "embeddings", "pages"])
def test_empty_tables(spark, name):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    docs = spark.createDataFrame([], DOCS)
    runs = {
        "documents": [
            lambda: toxicity(docs, labels),
            lambda: ngram_join(docs),
            lambda: pack(docs, TOKENIZER),
            lambda: repeated_spans(docs),
            lambda: exact_dedup(docs),
            lambda: lm_score(docs),
            lambda: license_lookup(docs),
            lambda: mix(docs),
            lambda: mixed_rows(docs),
        ],
        "embeddings": [lambda: embed_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))],
        "pages": [lambda: extract_main_text(spark.createDataFrame([], "page_id long, url string, html string"))],
    }
    for run in runs[name]:
        assert run().count() == 0


def test_ngram_links_of_many_sets_equal_brute_force():
    rng = np.random.default_rng(5)
    common = rng.choice(1 << 40, 300, replace=False)
    sets = []
    for k in range(60):
        # Some tokens are in all sets, some in every fifth, some in few, some in one.
        own = rng.choice(1 << 40, 8, replace=False)
        part = [common[:200], common[200:240] if k % 5 else own, rng.choice(common[240:], 6, replace=False)]
        sets.append(np.unique(np.concatenate(part).astype(np.uint64)))
    as_sets = [set(s.tolist()) for s in sets]
    for percent in (50, 85, 95, 100):
        want = [[x is not y and 100 * len(x & y) >= percent * len(x | y) for y in as_sets] for x in as_sets]
        assert ngram_links(sets, percent).tolist() == want
