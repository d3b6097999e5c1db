"""Importing this module registers every query."""

from stratalake.queries import checks, flows, logs, models  # noqa: F401
from stratalake.queries.registry import FUNCTIONS, ORACLES, QUERIES

__all__ = ["FUNCTIONS", "ORACLES", "QUERIES"]
