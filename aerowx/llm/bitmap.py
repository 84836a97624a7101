"""Bitmaps of keys that every task can hold: they may let other keys through, but lose none."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .words import mixed

_SHARE = 1 << 15


def _bit(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Byte and bit of each key in a bitmap of ``size`` bits."""
    at = mixed(keys.view(np.uint64), 13) % np.uint64(size)
    return (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8)


def has_bits(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key is set."""
    byte, bit = _bit(keys, 8 * len(bits))
    return (bits[byte] & bit) != 0


def _mark_bits(size: int):
    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            np.bitwise_or.at(bits, *_bit(batch.iloc[:, 0].to_numpy(), size))
        shares = [k for k in range(-(-len(bits) // _SHARE)) if bits[k * _SHARE : (k + 1) * _SHARE].any()]
        parts = [zlib.compress(bits[k * _SHARE : (k + 1) * _SHARE].tobytes(), 1) for k in shares]
        yield pd.DataFrame({"share": pd.Series(shares, dtype="int64"), "bits": pd.Series(parts, dtype=object)})

    return mark


def _either(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for share, blob in zip(batch["share"], batch["bits"]):
            part = np.frombuffer(zlib.decompress(blob), np.uint8)
            sums[share] = sums[share] | part if share in sums else part
    parts = [zlib.compress(x.tobytes(), 1) for x in sums.values()]
    yield pd.DataFrame({"share": pd.Series(list(sums), dtype="int64"), "bits": pd.Series(parts, dtype=object)})


def bitmap(keys: DataFrame, size: int):
    """A broadcast bitmap of a column of numbers: ``size`` bits, whatever the input."""
    marked = keys.mapInPandas(_mark_bits(size), "share long, bits binary").repartition(8, "share")
    bits = np.zeros(size // 8, np.uint8)
    for share, blob in marked.mapInPandas(_either, "share long, bits binary").collect():
        bits[share * _SHARE : (share + 1) * _SHARE] = np.frombuffer(zlib.decompress(blob), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(bits)
