"""File names, labels and addresses."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..contracts import MONTHLY_FILE
from .times import col


def path_part(path: Column | str, pattern: str, group: int) -> Column:
    """A group of the first match of ``pattern``; NULL without a match."""
    return F.when(col(path).rlike(pattern), F.regexp_extract(col(path), pattern, group))


def register_path_functions(spark: SparkSession, pattern: str = MONTHLY_FILE) -> None:
    """Offer ``path_code(path)`` and ``path_month(path)`` to SQL.

    They are SQL functions, which the planner expands in place.
    """
    for name, group in (("path_code", 1), ("path_month", 2)):
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(path STRING) RETURNS STRING "
            f"RETURN nullif(regexp_extract(path, r'{pattern}', {group}), '')"
        )


def name_parts(file_name: Column | str) -> tuple[Column, Column]:
    """``ACK_2023-1.parquet`` to ``ACK`` and ``2023-1``; a missing part is NULL."""
    c = col(file_name)
    code = F.when(c.contains("_"), F.split_part(c, F.lit("_"), F.lit(1)))
    rest = F.when(c.contains("_"), F.split_part(c, F.lit("_"), F.lit(2)))
    return code, F.split_part(rest, F.lit("."), F.lit(1))


def label(name: Column | str, suffix: str = "_avg") -> Column:
    """A variable name as a title: the suffix removed, first letter upper, rest lower."""
    bare = F.replace(col(name), F.lit(suffix), F.lit(""))
    return F.concat(F.upper(F.substring(bare, 1, 1)), F.lower(F.substr(bare, F.lit(2))))


def address(template: str, *parts: Column | str) -> Column:
    return F.format_string(template, *[col(p) for p in parts])
