"""Web pages: addresses, status, lists and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import path_part
from ..operators import positions, requests
from ..sources.pages import html_tables as tables_in
from .registry import TILES, query, table, tiles

_PATTERN = r"//([^/]+)/([a-z]{2})/"


@query(
    f"""
    SELECT page_id, nullif(regexp_extract(url, '{_PATTERN}', 1), '') AS host,
           nullif(regexp_extract(url, '{_PATTERN}', 2), '') AS lang,
           nullif(regexp_extract(url, '[?]page=([0-9]+)', 1), '') AS page
    FROM pages
    """
)
def path_parts(spark, folder):
    return table(spark, folder, "pages").select(
        "page_id",
        path_part("url", _PATTERN, 1).alias("host"),
        path_part("url", _PATTERN, 2).alias("lang"),
        path_part("url", "[?]page=([0-9]+)", 1).alias("page"),
    )


@query("SELECT page_id, NOT contains(html, '&amp;') AS usable FROM pages")
def page_status(spark, folder):
    pages = table(spark, folder, "pages")
    return requests.page_status(pages, error_text="&amp;").select("page_id", "usable")


@query(
    """
    SELECT count(*) FILTER (WHERE NOT contains(html, '&amp;')) AS working,
           count(*) FILTER (WHERE contains(html, '&amp;')) AS non_working
    FROM pages
    """
)
def status_counts(spark, folder):
    pages = table(spark, folder, "pages")
    return requests.status_counts(requests.page_status(pages, error_text="&amp;"))


@query(
    """
    SELECT page_id, 1 AS table_no, CAST(n - 1 AS INTEGER) AS row_no, items[n] AS item
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS items
          FROM pages), unnest(generate_series(1, len(items))) AS ns(n)
    """
)
def html_tables(spark, folder):
    """The pages hold lists, not tables: the same extraction with list tags."""
    rows = tables_in(table(spark, folder, "pages"), ["page_id"], "html", "ul", "li", ("li",))
    return rows.select("page_id", "table_no", "row_no", F.get("cells", F.lit(0)).alias("item"))


def _tables(spark, folder):
    """Each tile as three tables of 1, 4 and 3 columns; the last one is a row shorter."""
    number = F.when(F.col("col") < 1, 3).when(F.col("col") < 5, 4).otherwise(5)
    wide = _cell_texts(spark, folder).withColumn("table_no", number)
    return _as_rows(wide.where((F.col("table_no") < 5) | (F.col("row") < 7)))


def _cell_texts(spark, folder):
    whole = F.floor(F.col("value").cast("double") * 1000000).cast("bigint").cast("string")
    return tiles(spark, folder).select("scene", "row", "col", "value", whole.alias("text"))


def _as_rows(cells):
    ordered = F.transform(
        F.array_sort(F.collect_list(F.struct("col", "text"))), lambda c: c["text"]
    )
    rows = cells.groupBy("scene", "table_no", F.col("row").alias("row_no"))
    return rows.agg(ordered.alias("cells"))


_LAID = f"""
    {TILES}, laid AS (
        SELECT scene, "row" AS row_no,
               string_agg(CASE WHEN "col" < 5 OR "row" < 7
                   THEN CAST(CAST(floor(CAST(value AS DOUBLE) * 1000000) AS BIGINT) AS VARCHAR)
                   ELSE 'none' END, ',' ORDER BY "col") AS cells
        FROM tiles WHERE "row" >= 1 GROUP BY ALL)
"""


def _laid(spark, folder):
    laid = positions.side_by_side(_tables(spark, folder), ["scene"])
    text = F.array_join("cells", ",", "none")
    return laid.withColumn("cells", text)


@query(f"WITH {_LAID} SELECT scene, row_no, cells, 8 AS width FROM laid")
def concat_by_position(spark, folder):
    return _laid(spark, folder)


@query(
    f"""
    WITH {TILES}, counted AS (
        SELECT scene, "row", count(*) FILTER (value > 0) AS up,
               count(*) FILTER (coalesce(NOT value > 0, true)) AS down
        FROM tiles GROUP BY ALL),
    widths AS (SELECT scene, CAST(max(up) + max(down) AS INTEGER) AS width FROM counted GROUP BY ALL)
    SELECT scene, "row" AS row_no, width, width = 12 AS kept
    FROM counted JOIN widths USING (scene) WHERE "row" >= 1
    """
)
def width_guard(spark, folder):
    """Two tables to a tile, of its cells above zero and the others: widths differ by page."""
    side = F.when(F.col("value") > 0, 1).otherwise(2)
    rows = _as_rows(_cell_texts(spark, folder).withColumn("table_no", side))
    laid = positions.side_by_side(rows, ["scene"]).select("scene", "row_no", "width")
    good, rest = positions.split_by_width(laid, 12)
    return good.withColumn("kept", F.lit(True)).union(rest.withColumn("kept", F.lit(False)))
