"""Many points against many polygons: cells of a quadtree meet by equality, edges are tested on borders only.

A polygon is cut into the cells that lie wholly inside, as large as they come, and the smallest
cells that its border may cross. A point has one cell on each level, so it meets the cover by an
equi-join, and only where it met a border cell are the polygon's edges counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import enrich

#: Degrees of a cell on level 0, and where its first row and column begin.
WORLD = 360.0
WEST, SOUTH = -180.0, -180.0


def _size(level: int) -> float:
    return WORLD / (1 << level)


def _cell(position: Column, origin: float, level: int) -> Column:
    return F.floor((position - F.lit(origin)) / F.lit(_size(level))).cast("int")


def _edges(ring: Column) -> Column:
    """A ring of (lon, lat) points as edges; the last point joins the first."""
    after = F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))
    return F.zip_with(
        ring, after, lambda a, b: F.struct(a["lon"].alias("x1"), a["lat"].alias("y1"), b["lon"].alias("x2"), b["lat"].alias("y2"))
    )


def crosses_odd(edges: Column, lon: Column, lat: Column) -> Column:
    """Whether a ray to the east crosses an odd number of edges."""

    def crossed(e: Column) -> Column:
        meets = F.try_divide(e["x2"] - e["x1"], e["y2"] - e["y1"]) * (lat - e["y1"]) + e["x1"]
        return ((e["y1"] > lat) != (e["y2"] > lat)) & F.coalesce(lon < meets, F.lit(False))

    return F.size(F.filter(edges, crossed)) % 2 == 1


def _near(edges: Column, level: int) -> Column:
    """Edges whose box meets the cell (cx, cy), its sides included."""
    size = _size(level)
    west, south = F.col("cx") * size + WEST, F.col("cy") * size + SOUTH

    def meets(e: Column) -> Column:
        wide = (F.least(e["x1"], e["x2"]) <= west + size) & (F.greatest(e["x1"], e["x2"]) >= west)
        high = (F.least(e["y1"], e["y2"]) <= south + size) & (F.greatest(e["y1"], e["y2"]) >= south)
        return wide & high

    return F.exists(edges, meets)


def cover(polygons: DataFrame, key: str = "region_id", ring: str = "ring", first: int = 2, last: int = 7) -> DataFrame:
    """(key, level, cx, cy, border): the cells of each polygon, from level ``first`` to ``last``.

    ``ring`` is an array of (lon, lat). A polygon starts as the cells of its box on the first level; a
    cell near no edge is kept or dropped by its centre, another is quartered, on the last level kept as border.
    """
    shapes = polygons.where(F.size(ring) >= 3).select(key, _edges(F.col(ring)).alias("edges"))

    def span(a: str, b: str, origin: float) -> Column:
        places = F.transform("edges", lambda e: F.least(e[a], e[b])), F.transform("edges", lambda e: F.greatest(e[a], e[b]))
        return F.sequence(_cell(F.array_min(places[0]), origin, first), _cell(F.array_max(places[1]), origin, first))

    open_cells = shapes.withColumn("cx", F.explode(span("x1", "x2", WEST))).withColumn("cy", F.explode(span("y1", "y2", SOUTH)))
    found = []
    for level in range(first, last + 1):
        judged = open_cells.withColumn("near", _near(F.col("edges"), level))
        middle = [(F.col(c) + 0.5) * _size(level) + origin for c, origin in (("cx", WEST), ("cy", SOUTH))]
        cell = [key, F.lit(level).alias("level"), "cx", "cy"]
        inside = judged.where(~F.col("near")).where(crosses_odd(F.col("edges"), *middle))
        found.append(inside.select(*cell, F.lit(False).alias("border")))
        border = judged.where("near")
        if level == last:
            found.append(border.select(*cell, F.lit(True).alias("border")))
        quarters = {c: F.explode(F.array(F.col(c) * 2, F.col(c) * 2 + 1)) for c in ("cx", "cy")}
        open_cells = border.select(key, "edges", "cx", "cy").withColumn("cx", quarters["cx"]).withColumn("cy", quarters["cy"])
    return reduce(DataFrame.unionByName, found)


def in_regions(
    points: DataFrame,
    polygons: DataFrame,
    key: str = "region_id",
    ring: str = "ring",
    lon: str = "lon",
    lat: str = "lat",
    first: int = 2,
    last: int = 7,
    **bounds,
) -> DataFrame:
    """``points`` with the key of each polygon they lie in: none, one or several rows a point.

    Polygons may overlap. A point on an edge belongs to the side that a ray to the east says. Points
    without a coordinate, and rings of fewer than three points, meet nothing. The cover is
    broadcast if it is small, else cells that hold very many points are spread.
    """
    cells = cover(polygons, key, ring, first, last)
    # A cell once, with all its polygons: a point meets at most one row on each level.
    grouped = cells.groupBy("level", "cx", "cy").agg(F.collect_list(F.struct(key, "border")).alias("_met"))
    here = F.array(
        *[
            F.struct(F.lit(k).alias("level"), _cell(F.col(lon), WEST, k).alias("cx"), _cell(F.col(lat), SOUTH, k).alias("cy"))
            for k in range(first, last + 1)
        ]
    )
    known = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    placed = known.select("*", F.inline(here))
    met = enrich(placed, grouped, ["level", "cx", "cy"], "inner", **bounds)
    met = met.drop("level", "cx", "cy").withColumn("_met", F.explode("_met")).select(*points.columns, f"_met.{key}", "_met.border")
    sure = met.where(~F.col("border")).drop("border")
    edges = polygons.select(key, _edges(F.col(ring)).alias("_edges"))
    doubt = enrich(met.where("border").drop("border"), edges, key, "inner", **bounds)
    tested = doubt.where(crosses_odd(F.col("_edges"), F.col(lon), F.col(lat))).drop("_edges")
    return sure.unionByName(tested.select(*sure.columns))
