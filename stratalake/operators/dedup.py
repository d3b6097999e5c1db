"""Latest row per key.

``row_number() <= n`` directly above the window lets Spark keep only n rows per key in every map task
before the shuffle, so a key that holds a third of the table does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK = "__rank"


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """At most ``n`` rows per key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) <= n).drop(RANK)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The row with the greatest order columns per key. Further order columns break ties."""
    return first_n(df, keys, [F.col(c).desc_nulls_last() for c in order_cols], 1)


def last_n(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str], n: int) -> DataFrame:
    """The newest ``n`` rows per key, shown oldest first."""
    kept = first_n(df, keys, [F.col(c).desc_nulls_last() for c in order_cols], n)
    return kept.orderBy(*keys, *order_cols)


def collapse_versions(df: DataFrame, keys: Sequence[str], version: str, *ties: str) -> DataFrame:
    """Replace-by-version: the highest version per key."""
    return dedup_latest(df, keys, [version, *ties])
