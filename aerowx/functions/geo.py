"""Points, regions and grid cells."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import col

METRES_PER_DEGREE = 111_320.0


def _is_box(ring: Sequence[tuple[float, float]]) -> bool:
    xs, ys = {x for x, _ in ring}, {y for _, y in ring}
    steps = zip(ring, [*ring[1:], ring[0]])
    straight = all((a[0] == b[0]) != (a[1] == b[1]) for a, b in steps)
    return len(ring) == 4 and len(xs) == 2 and len(ys) == 2 and straight


def in_region(lon: Column | str, lat: Column | str, ring: Sequence[tuple[float, float]]) -> Column:
    """Whether a point lies in the polygon with these (lon, lat) corners.

    An upright box, edges included, becomes two ranges that reach the scan;
    any other polygon counts the edges that a ray to the east crosses.
    """
    x, y = col(lon), col(lat)
    if _is_box(ring):
        xs, ys = sorted({p[0] for p in ring}), sorted({p[1] for p in ring})
        return x.between(*xs) & y.between(*ys)
    crossings = []
    for (x1, y1), (x2, y2) in zip(ring, [*ring[1:], ring[0]]):
        if y1 == y2:
            continue
        spans = (F.lit(y1) > y) != (F.lit(y2) > y)
        meets = F.lit((x2 - x1) / (y2 - y1)) * (y - F.lit(y1)) + F.lit(x1)
        crossings.append((spans & (x < meets)).cast("int"))
    return (reduce(lambda a, b: a + b, crossings) % 2) == 1


def cell_index(position: Column | str, origin: float, size: float) -> Column:
    """The grid index of a coordinate: cells of ``size`` counted from ``origin``.

    NULL for a coordinate too far out for an integer index.
    """
    place = (col(position).cast("double") - F.lit(float(origin))) / F.lit(float(size))
    return F.when(F.abs(place) < F.lit(2.0**31 - 1), F.floor(place).cast("int"))


def square_bounds(lon: Column | str, lat: Column | str, half_side_metres: float) -> dict[str, Column]:
    """West, south, east and north of the square with this half side round a point."""
    up = F.lit(half_side_metres / METRES_PER_DEGREE)
    side = up / F.cos(col(lat) * F.lit(math.pi / 180.0))
    return {
        "west": col(lon) - side,
        "south": col(lat) - up,
        "east": col(lon) + side,
        "north": col(lat) + up,
    }
