"""Registration of queries together with their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stratalake.queries.lake import Lake, shown
from stratalake.queries.oracle_views import with_views

#: The registered functions on a lake, for callers that bring their own (for example a stored one).
FUNCTIONS: dict[str, Callable[[Lake], DataFrame]] = {}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(lake) -> DataFrame`` under a name; ``sql`` may use the shared views."""

    def register(function: Callable[[Lake], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        FUNCTIONS[name] = function
        QUERIES[name] = lambda spark, sf_dir: shown(function(Lake(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return function

    return register
