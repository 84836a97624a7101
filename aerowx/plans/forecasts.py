"""Forecasts: landed documents to the ``weather_forecasts`` table, and its lookups."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import contracts as C
from ..operators.conform import cast_to, flatten_forecasts, set_inside
from ..operators.joins import enrich
from ..operators.lookups import at_hour, series
from ..operators.sampling import first_per_key


def place_documents(documents: DataFrame, records: DataFrame, key: str = "airport_code") -> DataFrame:
    """Write each document's airport code and coordinates into its city.

    A document whose code is unknown keeps its code, without coordinates.
    """
    places = first_per_key(records.select(key, "coordinates"), [key])
    known = enrich(documents, places, key, "left")
    return set_inside(
        known,
        "city",
        {
            "name": F.col(key),
            "coordinates": F.struct(
                F.col("coordinates.lon").alias("lon"), F.col("coordinates.lat").alias("lat")
            ),
        },
    ).drop("coordinates")


def forecasts(documents: DataFrame) -> DataFrame:
    """The ``weather_forecasts`` contract from placed documents."""
    return cast_to(flatten_forecasts(documents), C.FORECASTS)


def forecast_table(table: DataFrame, code: str, moment: dt.datetime) -> DataFrame:
    """The forecast of an airport for the hour of ``moment``."""
    chosen = table.select(*C.FORECAST_LOOKUP_COLUMNS)
    return at_hour(chosen, "airport_code", code, "datetime_recorded", moment)


def forecast_series(table: DataFrame, code: str | None, variable: str) -> DataFrame:
    return series(
        table, "airport_code", "datetime_recorded", variable, C.FORECAST_VARIABLES, code
    )
