"""Mixing: rows without ids, rows that repeat, many texts of one size, one very long text."""

from collections import Counter, defaultdict

from aerowx.llm.mixing import mix, mixed_rows

SCHEMA = "doc_id long, text string, source string, size long, key string, rate string"


def taken_of(rows):
    taken, target = Counter(), {}
    for r in rows:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    return taken, target


def check(spark, rows, miss):
    docs = spark.createDataFrame([(i, t, s, 1, "k", None) for i, t, s in rows], SCHEMA)
    got = mix(docs).collect()
    assert len(got) == len(rows)
    taken, target = taken_of(got)
    for s in target:
        assert abs(taken[s] - target[s]) <= miss, (s, taken[s], target[s])
    again = mix(docs.repartition(7, "doc_id")).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    copies = defaultdict(int)
    for r in got:
        copies[r.doc_id, r.source] += r.copies
    kept = Counter((r.doc_id, r.source) for r in mixed_rows(docs).collect())
    assert kept == +Counter(copies)
    return got


def test_rows_without_ids(spark):
    check(spark, [(None, "ten words are in this text so it goes on", "ab"[k % 2]) for k in range(1000)], 10)


def test_rows_that_repeat(spark):
    rows = [(5, "one text", "a")] * 400 + [(k, f"one t{k}", "b") for k in range(301)] + [((1 << 60) + 1, "x y z", None)] * 77
    check(spark, rows, 3)


def test_texts_of_one_size(spark):
    check(spark, [(k, " ".join(["w"] * 20), "ab"[k % 3 == 0]) for k in range(3000)], 20)


def test_one_long_text_among_short_ones(spark):
    rows = [(0, "w " * 9000, "a")] + [(k, "w " * 50, "a") for k in range(1, 400)] + [(1000 + k, "w " * 70, "b") for k in range(300)]
    check(spark, rows, 70)


def test_sources_without_words(spark):
    got = check(spark, [(1, None, "a"), (2, "", "a"), (3, "one two", "b"), (4, " \t", None), (5, "three", "b")], 2)
    assert {r.doc_id: r.copies for r in got if r.size == 0} == {1: 1, 2: 1, 4: 1}
