"""Sorted rows streamed through Python one run of equal keys at a time, and columns packed into one value."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Places where any of the sorted keys changes, the first row included."""
    if len(keys[0]) == 0:
        return np.empty(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def whole_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that end at the end of a run: a run cut by a batch is carried over.

    Holds one batch and one run. Rows must come sorted, or at least grouped, by ``keys``.
    """
    carry: list[pd.DataFrame] = []
    for batch in batches:
        if len(batch) == 0:
            continue
        starts = run_starts(*[batch[k].to_numpy() for k in keys])
        same = carry and all(carry[-1][k].iloc[-1] == batch[k].iloc[0] for k in keys)
        if len(starts) == 1 and same:
            carry.append(batch)
            continue
        cut = starts[-1]
        head = [*carry, batch.iloc[:cut]] if cut else carry
        if head:
            yield pd.concat(head, ignore_index=True)
        carry = [batch.iloc[cut:]]
    if carry:
        yield pd.concat(carry, ignore_index=True)


def slices(frame: pd.DataFrame, keys: list[str]) -> Iterator[tuple[int, int]]:
    """First and last-plus-one row of each run in a frame of whole runs."""
    starts = run_starts(*[frame[k].to_numpy() for k in keys])
    yield from zip(starts.tolist(), [*starts[1:].tolist(), len(frame)])


def packed(columns: tuple[np.ndarray, ...], kinds: tuple) -> bytes:
    """Columns byte by byte, all lowest bytes of a column first, so that high bytes compress to nothing."""
    parts = [np.ascontiguousarray(c, dtype=k).view(np.uint8) for c, k in zip(columns, kinds)]
    return b"".join(p.reshape(-1, np.dtype(k).itemsize).T.tobytes() for p, k in zip(parts, kinds))


def unpacked(blob: bytes, kinds: tuple) -> list[np.ndarray]:
    widths = [np.dtype(k).itemsize for k in kinds]
    planes = np.frombuffer(blob, np.uint8).reshape(sum(widths), -1)
    ends = np.cumsum(widths)
    return [np.ascontiguousarray(planes[e - w : e].T).view(k).ravel() for e, w, k in zip(ends, widths, kinds)]
