"""The grid of monthly pages to ask for, and what came back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.text import address


def month_grid(
    codes: DataFrame, key: str, first_year: int, last_year: int, template: str = C.HISTORY_URL
) -> DataFrame:
    """One row per code, year and month with its page address: a projection, no join."""
    years = F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))
    months = F.explode(F.sequence(F.lit(1), F.lit(12)))
    return (
        codes.select(key, years.alias("year"))
        .select(key, "year", months.alias("month"))
        .withColumns(
            {
                "year_month": F.format_string("%d-%02d", "year", "month"),
                "url": address(template, key, "year", "month"),
            }
        )
    )


def page_status(
    pages: DataFrame, html: str = "html", error_text: str = C.MISSING_PAGE_TEXT
) -> DataFrame:
    """Add ``usable``: the page does not hold the error text."""
    return pages.withColumn(
        "usable", F.coalesce(~F.col(html).contains(F.lit(error_text)), F.lit(False))
    )


def status_counts(checked: DataFrame) -> DataFrame:
    return checked.agg(
        F.count_if("usable").alias("working"), F.count_if(~F.col("usable")).alias("non_working")
    )
