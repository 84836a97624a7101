"""The automaton's traversal against the recursion over histories, order by order."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from aerowx.llm.automaton import Automaton

BACKOFF = 3.0


def built(texts, train, order):
    """Automaton over all texts with the counts of those in training; and log10 p of each token by recursion."""
    counts = [Counter() for _ in range(order + 1)]
    for t in (t for t, used in zip(texts, train) if used):
        for n in range(1, order + 1):
            counts[n].update(tuple(t[k : k + n]) for k in range(len(t) - n + 1))
    total = sum(v for (w,), v in counts[1].items() if w)
    distinct = sum(1 for (w,) in counts[1] if w)

    def p(history, word):
        if not history:
            return (counts[1][word,] + 0.5) / (total + 0.5 * (distinct + 1))
        held = counts[len(history)][history]
        return (counts[len(history) + 1][*history, word] + BACKOFF * p(history[1:], word)) / (held + BACKOFF)

    want = [0.0 if k == 0 else math.log10(p(tuple(t[max(0, k - order + 1) : k]), w)) for t in texts for k, w in enumerate(t)]
    tokens = np.array([w for t in texts for w in t], np.uint64)
    place = np.array([k for t in texts for k in range(len(t))], np.int64)

    def count(n, ends):
        return np.array([counts[n][tuple(tokens[e - n + 1 : e + 1].tolist())] for e in ends], np.float64)

    return Automaton(tokens, place, count, order, total, distinct, BACKOFF), place, want


@pytest.mark.parametrize("order", [1, 2, 3, 4])
@pytest.mark.parametrize("run", [1, 3, 256])
def test_traversal_equals_recursion(order, run):
    rng = random.Random(order)
    # Token 0 starts a text, 1 ends it; some words are never trained, some texts hold no word.
    texts = [[0, *(rng.choice([2, 3, 4, 5, rng.randrange(6, 90)]) for _ in range(rng.choice([0, 1, 2, 9, 400]))), 1] for _ in range(40)]
    train = [k % 3 > 0 for k in range(40)]
    automaton, place, want = built(texts, train, order)
    assert automaton.traverse(place, run) == pytest.approx(want)


def test_states_and_failure_arcs():
    automaton, _, _ = built([[0, 2, 3, 2, 3, 1], [0, 2, 9, 1]], [True, False], 3)
    # Histories of one word that were trained: 0, 1, 2 and 3; of two words: (0 2), (2 3), (3 2) and (3 1).
    assert len(automaton.failure) == 1 + 4 + 4 and (automaton.failure < np.arange(9))[1:].all()
    assert (automaton.failure[1:5] == 0).all() and (automaton.failure[5:] > 0).all()
    # A failure arc weighs what the counts leave to the shorter history.
    assert sorted(automaton.weight[1:5]) == pytest.approx(sorted(math.log10(3 / (n + 3)) for n in (1, 1, 2, 2)))


def test_nothing_to_walk():
    automaton, place, want = built([], [], 3)
    assert automaton.traverse(place).tolist() == want == []
    automaton, place, want = built([[0, 1]], [False], 2)
    assert automaton.traverse(place) == pytest.approx(want)
