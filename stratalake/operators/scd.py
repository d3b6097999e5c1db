"""Slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.dedup import dedup_latest
from stratalake.operators.neighbour_rows import next_values, previous_values

# Fixed value: end of an open version.
OPEN_END = "9999-12-31 23:59:59"


def open_end() -> Column:
    return F.to_timestamp(F.lit(OPEN_END))


def scd2_init(df: DataFrame, valid_from: str) -> DataFrame:
    """Initial load: one open version per row, valid from the given column."""
    return df.withColumns({"valid_from": F.col(valid_from), "valid_to": open_end(), "is_current": F.lit(1)})


def current_only(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_current") == 1)


def scd2_history(changes: DataFrame, key: str, tracked: Sequence[str], ts: str, tie: str, bucket: Column | None = None) -> DataFrame:
    """All versions from a change history: a version starts where a tracked column changes.

    Rows of one key are handled in monthly buckets, so a key with very many changes is split.
    """
    month = F.trunc(ts, "month") if bucket is None else bucket
    state = F.struct(*[F.col(c) for c in tracked])
    ordered = previous_values(changes.withColumn("__state", state), [key], [ts, tie], {"__before": "__state"}, month)
    starts = ordered.filter(F.col("__before").isNull() | ~F.col("__state").eqNullSafe(F.col("__before")))
    ends = next_values(starts, [key], [ts, tie], {"__until": ts}, month)
    return ends.select(
        key,
        *tracked,
        F.col(ts).alias("valid_from"),
        F.coalesce("__until", open_end()).alias("valid_to"),
        F.col("__until").isNull().cast("int").alias("is_current"),
    )


def scd2_merge(dim: DataFrame, changes: DataFrame, key: str, tracked: Sequence[str], ts: str = "updated_at") -> DataFrame:
    """Merge one image per key: close the open version and insert a new one where a tracked column changed.

    Only the newest image of each key in ``changes`` counts; unchanged and older images leave the
    dimension as it is, so merging the same batch twice changes nothing.
    """
    latest = dedup_latest(changes, [key], [ts, *tracked])
    incoming = latest.select(F.col(key), F.struct(*tracked).alias("__new"), F.col(ts).alias("__new_from"))
    cols = [key, *tracked, "valid_from", "valid_to", "is_current"]
    both = current_only(dim).select(*cols).join(incoming, key, "full_outer")

    known = F.col("is_current").isNotNull()
    changed = (
        known
        & F.col("__new").isNotNull()
        & (F.col("__new_from") > F.col("valid_from"))
        & ~F.col("__new").eqNullSafe(F.struct(*tracked))
    )
    old = F.struct(
        *[F.col(c) for c in [key, *tracked, "valid_from"]],
        F.when(changed, F.col("__new_from")).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(changed, F.lit(0)).otherwise(F.col("is_current")).alias("is_current"),
    )
    new = F.struct(
        F.col(key),
        *[F.col("__new")[c].alias(c) for c in tracked],
        F.col("__new_from").alias("valid_from"),
        open_end().alias("valid_to"),
        F.lit(1).alias("is_current"),
    )
    rows = F.when(~known, F.array(new)).when(changed, F.array(old, new)).otherwise(F.array(old))
    merged = both.select(F.explode(rows).alias("__row")).select("__row.*")
    return dim.filter(F.col("is_current") != 1).select(*cols).unionByName(merged)
