"""Words of whole texts as 64-bit hashes, many texts at a time in numpy.

A word is a run of characters other than space and \\t to \\r, with A-Z lowered. Its
hash is a polynomial in its UTF-8 bytes, taken from one running sum over the buffer,
and then mixed with its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from .shared import LOWER, UPPER

_SPACES = b" \t\n\v\f\r"
_LOWERED = bytes.maketrans(UPPER.encode() + _SPACES, LOWER.encode() + b" " * len(_SPACES))
_WINDOW = 1 << 17
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ np.uint64((seed * 0xD1342543DE82EF95 + 0x2545F4914F6CDD1D) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        take = min(done, n - done)
        out[done : done + take] = out[:take] * np.uint64(pow(base, done, 1 << 64))
        done += take
    return out


_up = _powers(_BASE, _WINDOW + 1)
_down = _powers(pow(_BASE, -1, 1 << 64), _WINDOW + 1)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _up, _down
    if n > len(_up):
        _up, _down = _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)
    return _up, _down


def _hash_window(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    inside = buffer != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    up, down = _tables(len(buffer) + 1)
    total = np.concatenate(
        (np.zeros(1, np.uint64), np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * up[: len(buffer)]))
    )
    raw = (total[ends] - total[starts]) * down[starts]
    return starts, ends, mixed(raw + (ends - starts).astype(np.uint64) * np.uint64(_BASE))


def hash_words(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts, byte ends and hashes of the words of one buffer."""
    data = data.translate(_LOWERED)
    if len(data) <= _WINDOW:
        return _hash_window(np.frombuffer(data, np.uint8))
    parts, at = [], 0
    while at < len(data):
        end = min(at + _WINDOW, len(data))
        if end < len(data):
            cut = data.rfind(b" ", at, end)
            if cut < 0:
                cut = data.find(b" ", end)
            end = len(data) if cut < 0 else cut + 1
        starts, ends, hashes = _hash_window(np.frombuffer(data, np.uint8, end - at, at))
        parts.append((starts + at, ends + at, hashes))
        at = end
    return tuple(np.concatenate(x) for x in zip(*parts))


def text_words(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The word hashes of each text, in order; NULL has none.

    Texts are joined into buffers that fit a core's cache, so that short ones share the cost
    of the numpy calls and a long one is never joined to many others.
    """
    group: list[bytes] = []
    held = 0
    for text in texts:
        data = (text or "").encode("utf-8", "surrogatepass")
        if group and held + len(data) > _WINDOW:
            yield from _group_words(group)
            group, held = [], 0
        group.append(data)
        held += len(data) + 1
    if group:
        yield from _group_words(group)


def _group_words(group: list[bytes]) -> Iterator[np.ndarray]:
    starts, _, hashes = hash_words(b"\n".join(group))
    offsets = np.cumsum([0] + [len(x) + 1 for x in group])
    cuts = np.searchsorted(starts, offsets)
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield hashes[a:b]


def grams(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``size`` words, in order."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, (seed * 0xA0761D6478BD642F + size) & _MASK, np.uint64)
    for k in range(size):
        out = (out + words[k : k + n]) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(32)
    return mixed(out, seed)


def shingle_set(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct shingles; fewer words than ``size`` make one shingle, none make none."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    return np.unique(grams(words, min(size, len(words)), 1 + min(size, len(words))))
