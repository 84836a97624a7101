"""Historic weather: scraped pages or monthly files to ``historic_weather``, and its series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.text import label
from ..operators.conform import cast_to, rename
from ..operators.positions import named_cells, side_by_side, split_by_width
from ..operators.quality import split_rejects
from ..operators.requests import page_status
from ..operators.series import allowed, edges, weekly_mean, with_segments
from ..sources.files import dated, monthly_files
from ..sources.pages import html_tables


def staged_from_files(spark: SparkSession, folder: str) -> DataFrame:
    """Staging rows of all monthly files, with code, month and path."""
    return monthly_files(spark, folder)


def staged_from_pages(pages: DataFrame, key: str = "url") -> tuple[DataFrame, DataFrame]:
    """Staging rows out of history pages, and the pages that gave none.

    ``pages`` has ``key``, ``html``, ``airport_code`` and ``year_month``. The month's
    tables are laid side by side; a page of another width than the contract's is
    left out. Copies of a page count once; two versions of it both give rows. Each
    result parses the pages, so write the first one out before using the second.
    """
    named = [key, "airport_code", "year_month"]
    versions = page_status(pages).withColumn("_version", F.xxhash64("html"))
    tables = html_tables(versions.where("usable"), [*named, "_version"]).where(
        ~F.col("is_header")
        & F.col("table_no").between(C.FIRST_HISTORY_TABLE, C.LAST_HISTORY_TABLE)
    )
    laid = side_by_side(tables, [*named, "_version"])
    good, _ = split_by_width(laid, len(C.STAGING_NAMES))
    staged = named_cells(good, list(C.STAGING_NAMES)).drop("row_no", "_version")
    asked = pages.select(*named).distinct()
    return staged, asked.join(staged.select(key).distinct(), key, "left_anti")


def historic(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ``historic_weather`` contract, and rejected staging rows with a reason.

    Rejected are rows from a file that names no code and month, and rows whose day
    is no date of the month. A measurement that is no number is NULL.
    """
    rows = dated(staged.withColumn("_day", F.col("Date")))
    good, bad = split_rejects(
        rows,
        {
            "file name": F.col("airport_code").isNull() | F.col("year_month").isNull(),
            "date": F.col("Date").isNull(),
        },
    )
    rejected = bad.withColumn("Date", F.col("_day")).drop("_day")
    return cast_to(rename(good, C.STAGING_NAMES), C.HISTORIC), rejected


def weekly_series(table: DataFrame, variable: str, scale: int | None = None) -> DataFrame:
    """Weekly means of an allowed variable for all airports, with title and segments."""
    name = allowed(variable, C.HISTORIC_VARIABLES)
    weekly = weekly_mean(table, "airport_code", "date_recorded", name, scale)
    return with_segments(weekly, "airport_code").withColumn("variable", label(F.lit(name)))


def weekly_lines(table: DataFrame, variable: str, scale: int | None = None) -> DataFrame:
    """The line pieces to draw for an allowed variable, for all airports."""
    name = allowed(variable, C.HISTORIC_VARIABLES)
    return edges(
        weekly_mean(table, "airport_code", "date_recorded", name, scale), "airport_code"
    )
