"""Incremental tables: watermark, delete and insert by key, change application, retention.

Nothing overwrites a table that is read in the same plan: every operator returns the whole new content,
to be written to a new snapshot path. Where rewriting the table per load is too much, write the
:func:`new_rows` alone into a versioned table (``sources/versioned.py``) or replace day partitions
(:func:`overwrite_days`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import as_date, as_timestamp
from stratalake.operators.dedup import dedup_latest

EPOCH = "1970-01-01 00:00:00"


def watermark(target: DataFrame, ts: str, lookback: str = "1 hour", floor: str | None = "hour") -> Column:
    """Scalar subquery: the newest moment of the target, floored, minus the lookback; the epoch when empty."""
    newest = F.max(ts)
    if floor:
        newest = F.date_trunc(floor, newest)
    moment = F.coalesce(newest - F.expr(f"INTERVAL {lookback}"), as_timestamp(EPOCH))
    return target.agg(moment.alias("watermark")).scalar()


def new_rows(
    source: DataFrame,
    target: DataFrame,
    ts: str,
    lookback: str = "1 hour",
    floor: str | None = "hour",
    strict: bool = False,
    full_refresh: bool = False,
) -> DataFrame:
    """Source rows at or after the target's watermark (``strict``: only after)."""
    if full_refresh:
        return source
    mark = watermark(target, ts, lookback, floor)
    return source.filter(F.col(ts) > mark if strict else F.col(ts) >= mark)


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch."""
    gone = batch.select(*keys).distinct()
    return target.join(gone, list(keys), "left_anti").unionByName(batch)


def incremental_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    ts: str,
    lookback: str = "1 hour",
    floor: str | None = "hour",
    strict: bool = False,
    full_refresh: bool = False,
    dedupe: Sequence[str] = (),
) -> DataFrame:
    """New content of the target. ``dedupe`` names order columns to keep one row per key in the batch.

    Rows that arrive later than the lookback are missed by design; a full refresh picks them up.
    """
    batch = new_rows(source, target, ts, lookback, floor, strict, full_refresh)
    if dedupe:
        batch = dedup_latest(batch, keys, dedupe)
    return batch if full_refresh else delete_insert(target, batch, keys)


def reaggregate_recent(target: DataFrame, events: DataFrame, day: str, aggregate, days: int = 3) -> DataFrame:
    """Replace the last ``days`` days before the target's newest one by a fresh aggregate of the events."""
    since = target.agg(F.coalesce(F.date_sub(F.max(day), days), as_date("1970-01-01")).alias("since")).scalar()
    fresh = aggregate(events.filter(F.col(day) >= since))
    return delete_insert(target, fresh, [day])


def append_dedup(target: DataFrame, changes: DataFrame, keys: Sequence[str], cursor: str, *ties: str) -> DataFrame:
    """Union of both, newest row per key."""
    return dedup_latest(target.unionByName(changes), keys, [cursor, *ties])


def apply_cdc(target: DataFrame, changes: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: str) -> DataFrame:
    """Apply row images: the newest image per key replaces the row, or removes it when marked as deleted.

    An image that is older than the target's row (late delivery) changes nothing; an equally old one, a repeated delivery,
    replaces it. Order columns that the target does not hold are not compared.
    """
    latest = dedup_latest(changes, keys, order)
    known = [c for c in order if c in target.columns]
    image = latest.select(*keys, F.struct(*latest.columns).alias("__image"))
    both = target.select(*keys, F.struct(*target.columns).alias("__row")).join(image, list(keys), "full_outer")
    if known:
        rank = lambda side: F.struct(*[F.col(side)[c] for c in known])
        late = F.coalesce(F.col("__row").isNotNull() & F.col("__image").isNotNull() & (rank("__image") < rank("__row")), F.lit(False))
    else:
        late = F.lit(False)
    replaces = F.col("__image").isNotNull() & ~late
    mark = F.col("__image")[deleted]
    gone = replaces & mark.isNotNull() & (mark != "")
    chosen = [F.when(replaces, F.col("__image")[c]).otherwise(F.col("__row")[c]).alias(c) for c in target.columns]
    return both.filter(~gone).select(*chosen)


def apply_retention(df: DataFrame, ts: str, days: int, as_of) -> DataFrame:
    """Rows not older than ``days``. On a table partitioned by day the filter drops whole partitions."""
    return df.filter(F.col(ts) > as_timestamp(as_of) - F.make_dt_interval(F.lit(days)))


def purge_older_than(df: DataFrame, ts: str, days: int, as_of) -> DataFrame:
    """Rows that a clean-up by age keeps."""
    return df.filter(F.col(ts) >= as_timestamp(as_of) - F.make_dt_interval(F.lit(days)))


def replace_day(target: DataFrame, rows: DataFrame, day_col: str, day) -> DataFrame:
    """Delete the rows of one day, then insert that day's new rows: idempotent."""
    return target.filter(F.col(day_col) != as_date(day)).unionByName(rows.filter(F.col(day_col) == as_date(day)))


def overwrite_days(rows: DataFrame, path: str, day_col: str) -> str:
    """The same on disk: only the day partitions present in ``rows`` are replaced."""
    shaped = rows.hint("rebalance", day_col)
    shaped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day_col).parquet(path)
    return path
