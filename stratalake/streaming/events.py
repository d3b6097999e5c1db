"""Late data and duplicates on the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import collapse_versions
from stratalake.plans.marts import count_of
from stratalake.streaming.cdc import BATCH

LATENESS = "3 days"
COUNTED = {"logins": "login", "signups": "signup", "upgrades": "upgrade", "payment_failures": "payment_failed"}


def streaming_user_days(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Running counts per (day, user), to be written in update mode.

    Users are part of the state key: daily actives stay exact and a busy day is spread over all tasks.
    Events later than the watermark are dropped.
    """
    daily = events.withWatermark("occurred_at", lateness).groupBy(F.window("occurred_at", "1 day"), "user_id")
    counts = daily.agg(F.count("*").alias("total_events"), *[count_of("event_type", v).alias(k) for k, v in COUNTED.items()])
    return counts.select(F.to_date("window.start").alias("event_date"), "user_id", "total_events", *COUNTED)


def read_dau(spark: SparkSession, target: str) -> DataFrame:
    """Daily active users from the written updates: the last update per (day, user), then one row per day."""
    current = collapse_versions(spark.read.parquet(target), ["event_date", "user_id"], BATCH)
    sums = [F.sum(c).alias(c) for c in ("total_events", *COUNTED)]
    return current.groupBy("event_date").agg(F.count("*").alias("dau"), *sums)


def streaming_dedup(events: DataFrame, key: str = "event_id", ts: str = "occurred_at", lateness: str = LATENESS) -> DataFrame:
    """Every event id once, as long as its copies arrive within the watermark of each other."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])
