"""Rasters stored as square blocks, whose borders are sent to their neighbours.

A block is one row (scene, block_row, block_col, values): side × side values row by row, NULL where
a pixel is masked or missing. A patch that reaches over a border is cut from the block of its centre
once the block has a margin; so a pixel travels to the blocks it borders on, and not to every patch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDE = 64
_STEPS = (-1, 0, 1)
_PLACE = ["block_row", "block_col"]


def block_of(position: Column | str, side: int) -> Column:
    """The block that holds a row or column; negative ones included."""
    position = F.col(position) if isinstance(position, str) else position
    return F.floor(position / F.lit(side)).cast("int")


def _nulls(count: int, kind: str) -> Column:
    return F.array_repeat(F.lit(None).cast(kind), count)


def to_blocks(pixels: DataFrame, scene: Sequence[str] = ("scene",), side: int = SIDE) -> DataFrame:
    """Blocks of pixels (scene, row, col, value); of a cell given twice the larger value counts.

    Pixels shrink to lines of a block in each task before they shuffle, then lines meet as a
    block: at most ``side`` of them. A block without any pixel has no row.
    """
    kind = dict(pixels.dtypes)["value"]
    line = [*scene, "row", "block_col"]
    at = F.pmod(F.col("col"), F.lit(side))
    lines = (
        pixels.select(*scene, "row", block_of("col", side).alias("block_col"), at.alias("_at"), "value")
        .groupBy(*line)
        .agg(*[F.max(F.when(F.col("_at") == i, F.col("value"))).alias(f"_v{i}") for i in range(side)])
        .select(
            *scene,
            block_of("row", side).alias("block_row"),
            "block_col",
            F.struct(
                F.pmod(F.col("row"), F.lit(side)).alias("at"), F.array(*[f"_v{i}" for i in range(side)]).alias("values")
            ).alias("_line"),
        )
    )
    by_row = F.map_from_entries(F.collect_list("_line"))
    whole = F.transform(
        F.sequence(F.lit(0), F.lit(side - 1)),
        lambda r: F.coalesce(F.try_element_at(F.col("_rows"), r), _nulls(side, kind)),
    )
    return (
        lines.groupBy(*scene, *_PLACE)
        .agg(by_row.alias("_rows"))
        .select(*scene, *_PLACE, F.flatten(whole).alias("values"))
    )


def to_pixels(blocks: DataFrame, scene: Sequence[str] = ("scene",), side: int = SIDE) -> DataFrame:
    """The valid pixels (scene, row, col, value) of blocks."""
    cells = blocks.select(*scene, *_PLACE, F.posexplode("values").alias("_at", "value")).where("value IS NOT NULL")
    return cells.select(
        *scene,
        (F.col("block_row") * side + F.expr(f"cast(_at div {side} as int)")).alias("row"),
        (F.col("block_col") * side + F.col("_at") % side).alias("col"),
        "value",
    )


def _cut(values: Column, wide: int, top: int, left: int, height: int, width: int) -> Column:
    """A rectangle of a flat array whose lines are ``wide`` long."""
    rows = F.sequence(F.lit(top), F.lit(top + height - 1))
    return F.flatten(F.transform(rows, lambda r: F.slice(values, r * wide + F.lit(left + 1), width)))


def with_margin(
    blocks: DataFrame, margin: int, scene: Sequence[str] = ("scene",), side: int = SIDE
) -> DataFrame:
    """Blocks of (side + 2 margin)² values: each with the borders of its eight neighbours.

    A block sends itself to its own place and to each neighbour only the lines that border on
    it. Places next to a block that have none themselves get a row too. At most nine pieces
    meet, whatever the raster's size.
    """
    if not 0 < margin <= side:
        raise ValueError("a margin is at least 1 and at most a block's side")
    kind = dict(blocks.dtypes)["values"].removeprefix("array<").removesuffix(">")
    span = {-1: (side - margin, margin), 0: (0, side), 1: (0, margin)}
    around = [(r, c) for r in _STEPS for c in _STEPS]
    pieces = F.array(
        *[
            F.struct(
                F.lit(k).alias("piece"),
                (F.col("block_row") - r).alias("block_row"),
                (F.col("block_col") - c).alias("block_col"),
                _cut(F.col("values"), side, span[r][0], span[c][0], span[r][1], span[c][1]).alias("values"),
            )
            for k, (r, c) in enumerate(around)
        ]
    )
    sent = blocks.select(*scene, F.explode(pieces).alias("_p")).select(*scene, "_p.*")
    met = sent.groupBy(*scene, *_PLACE).agg(
        *[F.first(F.when(F.col("piece") == k, F.col("values")), ignorenulls=True).alias(f"_p{k}") for k in range(9)]
    )
    full = [
        F.coalesce(F.col(f"_p{k}"), _nulls(span[r][1] * span[c][1], kind)).alias(f"_p{k}")
        for k, (r, c) in enumerate(around)
    ]

    def band(r: int) -> Column:
        first, height = 3 * (r + 1), span[r][1]

        def line(i: Column) -> Column:
            parts = [(f"_p{first + c + 1}", span[c][1]) for c in _STEPS]
            return F.concat(*[F.slice(F.col(name), i * width + 1, width) for name, width in parts])

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(height - 1)), line))

    whole = met.select(*scene, *_PLACE, *full)
    return whole.select(*scene, *_PLACE, F.concat(*[band(r) for r in _STEPS]).alias("values"))


def patches_from_blocks(
    blocks: DataFrame,
    centres: DataFrame,
    size: int,
    scene: Sequence[str] = ("scene",),
    side: int = SIDE,
    fill: float = 0.0,
) -> DataFrame:
    """(scene, row, col, patch) round each distinct centre, as ``extract_patches`` gives them.

    Masked and missing pixels get ``fill``. Centres meet the block they lie in, by equality; a
    block has at most side² of them.
    """
    before = size // 2
    margin = max(1, before)
    wide = side + 2 * margin
    places = centres.select(*scene, "row", "col").distinct()
    places = places.withColumns({"block_row": block_of("row", side), "block_col": block_of("col", side)})
    found = places.join(with_margin(blocks, margin, scene, side).hint("merge"), [*scene, *_PLACE], "left")
    top = F.col("row") - F.col("block_row") * side + F.lit(margin - before)
    left = F.col("col") - F.col("block_col") * side + F.lit(margin - before)
    lines = F.sequence(F.lit(0), F.lit(size - 1))
    cut = F.flatten(F.transform(lines, lambda r: F.slice(F.col("values"), (top + r) * wide + left + 1, size)))
    filled = F.transform(cut, lambda v: F.coalesce(v, F.lit(fill)).cast("float"))
    bare = F.array_repeat(F.lit(fill).cast("float"), size * size)
    return found.select(*scene, "row", "col", F.coalesce(filled, bare).alias("patch"))
