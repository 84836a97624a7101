"""Conversation repair against a plain recursion and against SQL."""

from __future__ import annotations

import random
from functools import lru_cache

import duckdb
import pytest

from aerowx.llm.repair import KEEP, NEXT, cheapest, damaged, repair
from aerowx.llm.repair_sql import REPAIR_SQL

TURNS = "conv_id long, turn long, role string, text string, key string, copies_of long, lead string"


def by_recursion(steps, entry, exits):
    @lru_cache(None)
    def rest(i, state, inserts):
        ways = [(0, "")] if i == len(steps) and state in exits else []

        def go(cost, letters, way):
            if way is not None:
                ways.append((cost + way[0], letters + way[1]))

        if i < len(steps):
            initial, bad, cut_off, times = steps[i]
            go(2 * times, "D" * times, rest(i + 1, state, 3))
            if not bad:
                if (state, initial) in KEEP:
                    go(5 * cut_off, "K", rest(i + 1, KEEP[state, initial], 3))
                go(1 + 5 * cut_off, "R", rest(i + 1, NEXT[state], 3))
        if inserts:
            go(5, "I", rest(i, NEXT[state], inserts - 1))
        return min(ways, default=None)

    return rest(0, entry, 3)


def test_the_two_searches_meet_at_the_least_audit():
    rng = random.Random(1)
    for _ in range(1500):
        steps = []
        for _ in range(rng.randint(0, 9)):
            bad = rng.random() < 0.2
            steps.append((rng.choice("suauat") if rng.random() < 0.9 else "", bad, not bad and rng.random() < 0.3, rng.randint(1, 3) if bad else 1))
        entry, exits = rng.choice([0, 0, 1, 2, 3]), rng.choice([(0, 3), (0, 3), (1,), (2,), (3,), (0,)])
        assert cheapest(steps, entry, exits) == by_recursion(steps, entry, exits)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(5)
    rows = []
    for conv in [None, 1, 2, 3, 2**60 + 1, 2**60 + 3, *range(10, 40)]:
        for turn in rng.sample(range(-2, 80), 40 if conv in (1, 2, None) else rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "system", "tool", "", None, "u"])
            rows.append((conv, turn, role, rng.choice(["Hi.", "Yes!", "no end", "", "  \n", "a.b", None, "ü? "])))
        if rng.random() < 0.3:
            rows.append((conv, None, "user", "null turn."))
    rows += [(7, 3, "user", "same.")] * 9 + [(7, 4, "assistant", "same."), (8, 0, "user", "long. " * 50_000)]
    return [(*r, "k", 4, "l") for r in rows]


@pytest.fixture(scope="module")
def by_sql(turns):
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [r[:4] for r in turns])
    return sorted(con.execute(REPAIR_SQL).fetchall(), key=repr)


@pytest.mark.parametrize("segment, chars", [(512, 1 << 20), (1, 1 << 20), (3, 40)])
def test_whole_and_cut_conversations_agree_with_sql(spark, turns, by_sql, segment, chars):
    df = spark.createDataFrame(turns, TURNS).repartition(3)
    got = repair(damaged(df), segment=segment, segment_chars=chars)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == by_sql


def test_no_turns(spark):
    empty = spark.createDataFrame([], TURNS)
    assert repair(empty).count() == 0 and repair(damaged(empty)).count() == 0
    gone = spark.createDataFrame([(5, 1, "user", "x.", 0)], "conv_id long, turn long, role string, text string, copies long")
    (row,) = repair(gone).collect()
    assert (row.conv_id, row.cost, row.audit, row.gaps) == (5, 0, "", 0)
    assert row.repaired_sha256 == "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
