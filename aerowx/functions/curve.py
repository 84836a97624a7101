"""Keys along a space-filling curve, so that rows near each other in three dimensions are stored together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import col

#: Bits of each of three numbers in a 63-bit key.
BITS = 21
#: Shifts that move the bits of a number two places apart, each with the bits that stay.
_SPREAD = [
    (32, 0x001F00000000FFFF),
    (16, 0x001F0000FF0000FF),
    (8, 0x100F00F00F00F00F),
    (4, 0x10C30C30C30C30C3),
    (2, 0x1249249249249249),
]


def _apart(number: Column) -> Column:
    whole = F.least(F.greatest(number.cast("bigint"), F.lit(0)), F.lit((1 << BITS) - 1))

    def move(x: Column, step: tuple[int, int]) -> Column:
        return x.bitwiseOR(F.shiftleft(x, step[0])).bitwiseAND(F.lit(step[1]))

    return F.when(number.isNotNull(), reduce(move, _SPREAD, whole))


def curve_key(x: Column | str, y: Column | str, z: Column | str) -> Column:
    """The place on a Z-order curve: the bits of three whole numbers in turn, the first's foremost.

    Numbers below 0 or from 2**21 on count as the nearest that fits, which only stores them less
    well; with a NULL among them the key is NULL.
    """
    parts = [F.shiftleft(_apart(col(c)), k) for c, k in ((x, 2), (y, 1), (z, 0))]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)
