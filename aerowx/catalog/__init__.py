"""All checked queries."""

from . import grids, landed, nested, pages, rasters, relational, sampling, series  # noqa: F401
from .registry import ORACLE, QUERIES  # noqa: F401
