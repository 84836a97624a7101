"""Tables of a page laid side by side by row position, and the width guard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def side_by_side(rows: DataFrame, keys: Sequence[str], skip: int = 1) -> DataFrame:
    """Join the tables of each page column-wise on the row number.

    Input (*keys, table_no, row_no, cells); output (*keys, row_no, cells, width) with
    the cells in table order. A table's width is that of its widest row; a table too
    short for a row gives NULLs there. The first ``skip`` rows are left out.

    Copies of a row are dropped in each task first, so that a page landed many times
    weighs as much as one; of several versions of a row, the smallest by its cells stays.
    From then on a page's rows stay together: the widths, the layout and the joined rows
    take one shuffle by page.
    """
    keys = list(keys)
    page = Window.partitionBy(*keys)
    wide = F.max(F.size("cells")).over(Window.partitionBy(*keys, "table_no"))
    sized = (
        rows.groupBy(*keys, "table_no", "row_no")
        .agg(F.min("cells").alias("cells"))
        .repartition(*keys)
        .withColumn("_wide", wide)
        .withColumn("_widths", F.collect_set(F.struct("table_no", "_wide")).over(page))
    )

    def total(widths):
        return F.aggregate(widths, F.lit(0), lambda n, t: n + t["_wide"])

    earlier = F.filter("_widths", lambda t: t["table_no"] < F.col("table_no"))
    placed = F.transform(
        "cells",
        lambda cell, i: F.struct((F.col("_offset") + i).alias("place"), cell.alias("text")),
    )
    by_place = F.map_from_entries(F.flatten(F.collect_list("_cells")))
    return (
        sized.where(F.col("row_no") >= skip)
        .withColumns({"_offset": total(earlier), "width": total(F.col("_widths"))})
        .select(*keys, "row_no", "width", placed.alias("_cells"))
        .groupBy(*keys, "row_no", "width")
        .agg(by_place.alias("_by_place"))
        .select(
            *keys,
            "row_no",
            F.transform(
                F.sequence(F.lit(0), F.col("width") - 1),
                lambda i: F.try_element_at("_by_place", i),
            ).alias("cells"),
            "width",
        )
    )


def split_by_width(rows: DataFrame, expected: int) -> tuple[DataFrame, DataFrame]:
    """Rows of pages with the expected width, and the rest."""
    return rows.where(F.col("width") == expected), rows.where(F.col("width") != expected)


def named_cells(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The cells array as named columns; other columns are kept."""
    kept = [c for c in rows.columns if c not in ("cells", "width")]
    return rows.select(*kept, *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)])
