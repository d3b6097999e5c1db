"""Daily actives as sketches: the state of a day is one sketch, however many users it has, and days are merged on read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import collapse_versions
from stratalake.streaming.cdc import BATCH
from stratalake.streaming.events import LATENESS

#: Logarithm of the sketch's registers: 16,384 of them, a relative error of about 0.8%.
REGISTERS = 14


def streaming_day_sketches(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Running ``(event_date, total_events, users)`` per day, to be written in update mode; ``users`` is a sketch of the user ids.

    Sketches are built in the map tasks and merged, so a busy day sends one row per task. Null ids are in no sketch.
    Events later than the watermark are dropped.
    """
    daily = events.withWatermark("occurred_at", lateness).groupBy(F.window("occurred_at", "1 day"))
    sketch = F.hll_sketch_agg(F.col("user_id").cast("bigint"), REGISTERS).alias("users")
    return daily.agg(F.count("*").alias("total_events"), sketch).select(F.to_date("window.start").alias("event_date"), "total_events", "users")


def read_day_sketches(spark: SparkSession, target: str) -> DataFrame:
    """The last written sketch of each day."""
    return collapse_versions(spark.read.parquet(target), ["event_date"], BATCH).drop(BATCH)


def rolling_actives(days: DataFrame, length: int) -> DataFrame:
    """``(event_date, actives)``: estimated distinct users of each day and the ``length - 1`` days before it, for the days that have a sketch.

    Only sketches are read: each goes to the ``length`` days it counts for.
    """
    known = days.select(F.col("event_date").alias("known"))
    every = F.explode(F.sequence("event_date", F.date_add("event_date", length - 1))).alias("day")
    spread = days.select(every, "users").join(known, F.col("day") == F.col("known"), "left_semi")
    return spread.groupBy(F.col("day").alias("event_date")).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("actives"))


def exact_rolling_actives(events: DataFrame, length: int) -> DataFrame:
    """The exact twin of ``rolling_actives`` from ``(occurred_at, user_id)``: users are counted once per day they count for."""
    seen = events.select(F.to_date("occurred_at").alias("event_date"), "user_id").distinct()
    known = seen.select(F.col("event_date").alias("known")).distinct()
    every = F.explode(F.sequence("event_date", F.date_add("event_date", length - 1))).alias("day")
    spread = seen.select(every, "user_id").distinct().join(known, F.col("day") == F.col("known"), "left_semi")
    return spread.groupBy(F.col("day").alias("event_date")).agg(F.count_distinct("user_id").alias("exact"))
