"""Keyed tables that keep versions: a load writes only its own rows, the reader collapses them.

A load lands under its batch id and overwrites that folder when it is replayed. Its cost follows the
load, not the table, and delivering a load more than once leaves exactly one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.dedup import collapse_versions
from stratalake.session import scratch_path

BATCH = "batch_id"
#: Keys with several versions that are sent to every task at most; with more of them all rows are shuffled.
FEW_KEYS = 250_000


def write_batch(rows: DataFrame, target: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")


def read_target(spark: SparkSession, target: str, keys: Sequence[str], version: str) -> DataFrame:
    """Current rows: highest version per key, later batches win ties.

    The keys alone are counted first. Where few have several versions, only the rows of those are shuffled and collapsed; all other
    rows are current as they are.
    """
    rows, path = spark.read.parquet(target), scratch_path(spark, "repeated")
    counted = rows.groupBy(*keys).agg(F.count("*").alias("__versions")).filter("__versions > 1")
    counted.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)]).write.parquet(path)
    repeated = spark.read.parquet(path)
    if repeated.count() > FEW_KEYS:
        return collapse_versions(rows, keys, version, BATCH).drop(BATCH)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key{i}")) for i, k in enumerate(keys)])
    alone, several = (rows.join(F.broadcast(repeated), same, kind) for kind in ("left_anti", "left_semi"))
    return alone.unionByName(collapse_versions(several, keys, version, BATCH)).drop(BATCH)


def compact(spark: SparkSession, target: str, new_target: str, keys: Sequence[str], version: str) -> str:
    """Write the current rows as one batch of a new target folder."""
    write_batch(read_target(spark, target, keys, version), new_target, 0)
    return new_target
