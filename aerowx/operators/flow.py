"""Breaks between steps: even out the rows before costly work, or bound its tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def reshuffle(df: DataFrame, *keys: str) -> DataFrame:
    """Spread rows evenly by ``keys``, which should tell rows apart, before a costly step.

    The number of tasks follows the data: spark.sql.shuffle.partitions at most.
    """
    return df.repartition(*keys)


def at_most_parallel(df: DataFrame, tasks: int, *keys: str) -> DataFrame:
    """Let no more than ``tasks`` tasks work on the next step, such as calls to a service."""
    return df.repartition(tasks, *keys)
