"""Named queries over the driver's tables, each with its twin in SQL."""

from . import calendars, cleaning, dims, facts, gold, keys, loads, rowsets, views  # noqa: F401
from .base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
