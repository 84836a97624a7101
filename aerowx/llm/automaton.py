"""A weighted backoff automaton as arrays: states, arcs, failure arcs, and its traversal.

States are histories seen in training, numbered from the root, which has none. The arc of a state
for a word holds log10 of its smoothed probability and the state it leads to: the longest end of
history and word that is a state. A state has arcs only for words that followed it in training;
for others its failure arc, with the log10 of a weight, leads to the state without the oldest word.
The root has an arc for every word.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

#: Tokens that are walked in a row; longer texts are cut, each piece with the words its first state needs.
RUN = 256


class Automaton:
    """Built from a flat row of texts (tokens and their places in the text) and the counts of their n-grams.

    ``count(n, ends)`` gives training counts of the n-grams that end at some places of the row.
    """

    def __init__(
        self,
        tokens: np.ndarray,
        place: np.ndarray,
        count: Callable[[int, np.ndarray], np.ndarray],
        order: int,
        total_tokens: int,
        distinct: int,
        backoff: float,
    ):
        self.order = order
        kinds, example, self.word = np.unique(tokens, return_index=True, return_inverse=True)
        self.words = max(1, len(kinds))
        seen = count(1, example)
        p = (seen + 0.5) / (total_tokens + 0.5 * (distinct + 1))
        self.root_log = np.log10(p)
        self.seen = seen[self.word] if len(tokens) else np.empty(0)
        failure, weight = [np.zeros(1, np.int64)], [np.zeros(1)]
        sources, logs, leads = [], [], []
        # gram: for each place, the number of the n-gram that ends there; state: of each n-gram, its own
        # or that of its longest end that is one.
        gram, states = self.word, 1
        state = np.zeros(len(kinds), np.int64)
        if order > 1:
            state, states = self._number(seen, state, states, failure, weight, backoff)
        self.root_lead = state
        for n in range(2, order + 1):
            ends = np.flatnonzero(place >= n - 1)
            pair = gram[ends - 1] * self.words + self.word[ends]
            found, first, number = np.unique(pair, return_index=True, return_inverse=True)
            at = ends[first]
            prefix, suffix = gram[at - 1], gram[at]
            times = count(n, at)
            longer = (times + backoff * p[suffix]) / (seen[prefix] + backoff)
            shorter = state[suffix]
            own = shorter
            if n < order:
                own, states = self._number(times, shorter, states, failure, weight, backoff)
            arc = times > 0
            sources.append(state[prefix[arc]] * self.words + found[arc] % self.words)
            logs.append(np.log10(longer[arc]))
            leads.append(own[arc])
            gram = np.full(len(tokens), -1, np.int64)
            gram[ends] = number
            seen, p, state = times, longer, own
        self.failure, self.weight = np.concatenate(failure), np.concatenate(weight)
        source = np.concatenate([*sources, np.empty(0, np.int64)])
        by_source = np.argsort(source, kind="stable")
        self.source = source[by_source]
        self.log = np.concatenate([*logs, np.empty(0)])[by_source]
        self.lead = np.concatenate([*leads, np.empty(0, np.int64)])[by_source]

    @staticmethod
    def _number(seen, shorter, states, failure, weight, backoff):
        """States for the n-grams that were seen, with failure arcs; others are that of their end."""
        own = seen > 0
        state = np.where(own, states + np.cumsum(own) - 1, shorter)
        failure.append(shorter[own])
        weight.append(np.log10(backoff / (seen[own] + backoff)))
        return state, states + int(own.sum())

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log10 of a word's probability in a state, and the state after it, for many at once."""
        log, after = np.zeros(len(state)), np.empty(len(state), np.int64)
        waiting, state = np.arange(len(state)), state
        while len(waiting):
            wanted = state * self.words + word[waiting]
            root = state == 0
            after[waiting[root]] = self.root_lead[word[waiting[root]]]
            log[waiting[root]] += self.root_log[word[waiting[root]]]
            at = np.minimum(np.searchsorted(self.source, wanted), max(0, len(self.source) - 1))
            hit = ~root & (self.source[at] == wanted) if len(self.source) else np.zeros(len(at), bool)
            after[waiting[hit]] = self.lead[at[hit]]
            log[waiting[hit]] += self.log[at[hit]]
            rest = ~root & ~hit
            waiting, state = waiting[rest], state[rest]
            log[waiting] += self.weight[state]
            state = self.failure[state]
        return log, after

    def traverse(self, place: np.ndarray, run: int = RUN) -> np.ndarray:
        """log10 of every token's probability; 0 for the starts of texts, which are given.

        Texts are walked from left to right with a state each, all at the same time. A piece of a long
        text starts at the root and first reads the words before it, as many as a state remembers.
        """
        logs = np.zeros(len(place))
        begins = np.flatnonzero((place > 0) & ((place - 1) % run == 0))
        text_ends = np.append(np.flatnonzero(place == 0)[1:], len(place))
        text = np.cumsum(place == 0)[begins] - 1
        length = np.minimum(run, text_ends[text] - begins)
        longest_first = np.argsort(-length, kind="stable")
        begins, length = begins[longest_first], length[longest_first]
        state = np.zeros(len(begins), np.int64)
        for k in range(1 - self.order, 0):
            known = np.flatnonzero(place[begins] + k >= 0)
            state[known] = self.step(state[known], self.word[begins[known] + k])[1]
        for k in range(int(length[0]) if len(length) else 0):
            walking = int(np.searchsorted(-length, -k, side="left"))
            at = begins[:walking] + k
            logs[at], state[:walking] = self.step(state[:walking], self.word[at])
        return logs
