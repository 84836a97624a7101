"""Airports: landed service pages to the ``airports`` table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from .. import contracts as C
from ..operators.conform import cast_to
from ..operators.joins import drop_listed
from ..operators.sampling import at_most_per_group
from ..sources.files import json_documents, unwrap_airports


def airport_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the landed JSON pages, coordinates included."""
    return unwrap_airports(json_documents(spark, path, C.AIRPORT_PAGE))


def airports(records: DataFrame, limits: Mapping[str, int] | None = None) -> DataFrame:
    """The ``airports`` contract; with limits, so many per country by code and no other country."""
    taken = records
    if limits is not None:
        taken = at_most_per_group(
            records, "country_name", limits, ["airport_code", "airport_name"]
        )
    return cast_to(taken, C.AIRPORTS)


def airport_map(table: DataFrame) -> DataFrame:
    """The airports to show, without those whose coordinates are wrong."""
    return drop_listed(table.select(*C.AIRPORT_MAP_COLUMNS), "airport_code", C.EXCLUDED_CODES)
