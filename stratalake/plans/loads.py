"""Incremental models: the rows a model makes from new source rows, added to a stored target."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from stratalake.operators.incremental import new_rows
from stratalake.sources.versioned import read_target, write_batch

Model = Callable[[DataFrame], DataFrame]


def build_model(model: Model, source: DataFrame, target: str) -> None:
    """First build: all source rows, as batch 0 of the versioned target folder."""
    write_batch(model(source), target, 0)


def load_model(model: Model, source: DataFrame, target: str, ts: str, batch_id: int, lookback: str = "1 hour", floor: str | None = "hour") -> None:
    """Add what the model makes of the source rows since the target's newest moment less the lookback.

    Of the target only the moments are read, and only the new batch is written. Source and model name the moment alike. Replaying
    a batch overwrites it, so a load may be repeated.
    """
    spark = source.sparkSession
    before = spark.read.parquet(target).filter(f"batch_id < {int(batch_id)}").select(ts)
    write_batch(model(new_rows(source, before, ts, lookback, floor)), target, batch_id)


def read_model(source: DataFrame, target: str, keys: Sequence[str], ts: str) -> DataFrame:
    """Current rows of the target: the newest per key, of equally new ones that of the later batch."""
    return read_target(source.sparkSession, target, keys, ts)
