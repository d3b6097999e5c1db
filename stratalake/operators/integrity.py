"""Key integrity between tables.

All checks are written as anti or semi joins on the key, never as ``NOT IN``: a null-aware anti join can
only run as a broadcast, while these can shuffle both sides.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_counts(child: DataFrame, key: str) -> DataFrame:
    """Rows per key value: the join below then moves one row per value, however often it occurs."""
    return child.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows"))


def orphan_rows(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, null_is_orphan: bool = True) -> DataFrame:
    """Child rows without a parent. NULL keys count as orphans unless ``null_is_orphan`` is off."""
    keys = parent.select(F.col(parent_key or key).alias(key)).distinct()
    rows = child if null_is_orphan else child.filter(F.col(key).isNotNull())
    return rows.join(keys, key, "left_anti")


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, null_is_orphan: bool = True) -> DataFrame:
    """One row: number of orphaned child rows."""
    lost = orphan_rows(key_counts(child, key), parent, "key", parent_key or key, null_is_orphan)
    return lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("orphans"))


def fk_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Non-NULL child keys that no parent row has, with their number of rows."""
    lost = orphan_rows(key_counts(child, key), parent, "key", parent_key or key, null_is_orphan=False)
    return lost.select(F.col("key").alias(key), "rows")


def matched_rows(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """One row: child rows that do have a parent (the EXISTS form)."""
    found = key_counts(child, key).join(parent.select(F.col(parent_key or key).alias("key")).distinct(), "key", "left_semi")
    return found.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("matched"))


@dataclass(frozen=True)
class Reference:
    """A foreign key to check."""

    name: str
    child: DataFrame
    parent: DataFrame
    key: str
    parent_key: str | None = None


def referential_integrity(references: Sequence[Reference], exists_form: bool = False) -> DataFrame:
    """Orphaned rows of every foreign key. ``exists_form`` counts total minus matched rows instead."""
    parts = []
    for ref in references:
        if exists_form:
            total = ref.child.agg(F.count("*").alias("total"))
            matched = matched_rows(ref.child, ref.parent, ref.key, ref.parent_key).scalar()
            lost = total.select((F.col("total") - matched).alias("orphans"))
        else:
            lost = orphans(ref.child, ref.parent, ref.key, ref.parent_key)
        parts.append(lost.select(F.lit(ref.name).alias("check"), F.col("orphans").cast("bigint").alias("orphans")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("ok", F.col("orphans") == 0)
