"""Keyed tables in buckets: a merge reads and replaces only the buckets that its changes touch.

The bucket of a row is a hash of its key and a folder of its own. A merge writes the new content of the touched buckets aside, under its
batch id, and then replaces their folders. A merge that was interrupted is run again: the functions that combine give the same
rows when they see a batch twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"
#: Buckets of a table; a bucket should be a file or a few.
BUCKETS = 64


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def create(rows: DataFrame, target: str, keys: Sequence[str], buckets: int = BUCKETS) -> None:
    """Write all buckets of a new table. Rows without a key take no part."""
    _write(_placed(rows, keys, buckets), target)


def read(spark: SparkSession, target: str, like: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of all buckets, with the columns of ``like``."""
    return _scan(spark, target, like, keys).drop(BUCKET)


def touched(target: DataFrame, changes: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Rows of the buckets that hold a key of the changes; the others are left out when the files are listed."""
    hit = changes.agg(F.collect_set(bucket_of(keys, buckets)).alias("hit")).scalar()
    return target.filter(F.array_contains(hit, F.col(BUCKET)))


def merge(
    changes: DataFrame, target: str, like: DataFrame, keys: Sequence[str], combine: Callable[[DataFrame, DataFrame], DataFrame], batch_id: int, buckets: int = BUCKETS
) -> None:
    """Replace the touched buckets by ``combine(their rows, changes)``.

    ``like`` has the columns of the table. Every replaced bucket also gets a row without a key, which readers leave out, so that one that
    loses its last row is replaced as well.
    """
    spark = changes.sparkSession
    usable = changes.filter(F.col(keys[0]).isNotNull())
    before = touched(_scan(spark, target, like, keys), usable, keys, buckets).drop(BUCKET)
    content = _placed(combine(before, usable).select(*like.columns), keys, buckets)
    hit = usable.select(bucket_of(keys, buckets).alias(BUCKET)).distinct()
    aside = f"{target}.merges/batch_id={batch_id}"
    content.unionByName(hit, allowMissingColumns=True).write.mode("overwrite").parquet(aside)
    merged = spark.read.schema(content.schema).parquet(aside)
    _write(merged, target)


def _placed(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.filter(F.col(keys[0]).isNotNull()).withColumn(BUCKET, bucket_of(keys, buckets))


def _scan(spark: SparkSession, target: str, like: DataFrame, keys: Sequence[str]) -> DataFrame:
    schema = like.withColumn(BUCKET, F.lit(0)).schema
    return spark.read.schema(schema).parquet(target).filter(F.col(keys[0]).isNotNull())


def _write(rows: DataFrame, target: str) -> None:
    rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(target)
