"""Previous and next row per key for keys of any size.

A plain ``lag`` puts all rows of a key into one task. Here every key is cut into time buckets: a window runs inside (key, bucket),
and a second one over the keys' bucket borders only, one row for each bucket. The other rows stay in their bucket during the second
window. The input is read once, NULL keys are one key, and no key needs to be known as large.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET, SIDE, NEAR, BORDER, SLOT = "__bucket", "__side", "__near", "__border", "__slot"


def _across(keys: Sequence[str]) -> Window:
    """Borders of a key together, other rows by bucket; borders come in order of their buckets."""
    return Window.partitionBy(*keys, SLOT).orderBy(BUCKET)


def _slot() -> Column:
    return F.when(~F.col(BORDER), F.col(BUCKET))


def _neighbour(df, keys, order, values, bucket, forward: bool) -> DataFrame:
    carried = F.struct(*[F.col(source).alias(name) for name, source in values.items()])
    shift, far = (F.lead, F.first) if forward else (F.lag, F.last)
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cut = df.withColumn(BUCKET, bucket).withColumns(
        {NEAR: shift(carried).over(inside), SIDE: far(carried).over(whole), BORDER: shift(F.lit(1)).over(inside).isNull()}
    )
    cut = cut.withColumn(SLOT, _slot())
    moved = cut.withColumn(SIDE, shift(SIDE).over(_across(keys)))
    taken = F.when(F.col(BORDER), F.col(SIDE)).otherwise(F.col(NEAR))
    return moved.withColumns({name: taken[name] for name in values}).drop(BUCKET, SIDE, NEAR, BORDER, SLOT)


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], bucket: Column) -> DataFrame:
    """Add columns ``new name -> column`` taken from the previous row of the same key.

    ``order`` must be a total order per key without NULLs, and ``bucket`` a date that never decreases
    along it.
    """
    return _neighbour(df, keys, order, values, bucket, False)


def next_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], bucket: Column) -> DataFrame:
    """Like :func:`previous_values` with the following row."""
    return _neighbour(df, keys, order, values, bucket, True)


def last_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str, bucket: Column) -> DataFrame:
    """Add the greatest non-NULL ``value`` among all earlier rows of the key.

    The values must not decrease along the order (a moment, a sequence number), so the maximum of the
    earlier buckets together with the running maximum inside the bucket is the last one.
    """
    inside = Window.partitionBy(*keys, BUCKET).orderBy(*order)
    whole = inside.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    cut = df.withColumn("__value", value).withColumn(BUCKET, bucket)
    cut = cut.withColumns({SIDE: F.max("__value").over(whole), NEAR: F.max("__value").over(before), BORDER: F.lag(F.lit(1)).over(inside).isNull()})
    cut = cut.withColumn(SLOT, _slot())
    earlier = _across(keys).rowsBetween(Window.unboundedPreceding, -1)
    moved = cut.withColumn(SIDE, F.when(F.col(BORDER), F.max(SIDE).over(earlier)))
    # The border row hands what it got to the other rows of its bucket.
    shared = moved.withColumn(SIDE, F.max(SIDE).over(whole))
    return shared.withColumn(name, F.greatest(NEAR, SIDE)).drop(BUCKET, SIDE, NEAR, BORDER, SLOT, "__value")
