"""Landing files: scans, presence check, inventory."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratalake.functions.dates import as_timestamp

# A prefix is fresh below 25 hours and only late up to 48.
FRESH_HOURS = 25
LATE_HOURS = 48


def scan_prefix(spark: SparkSession, path: str, schema: StructType | None = None, glob: str = "*.parquet") -> DataFrame:
    """All Parquet files of a prefix. A given schema saves the footer reads of schema inference."""
    reader = spark.read.option("pathGlobFilter", glob)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def file_listing(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row per file below ``root``: path, length, modification time. File contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def rows_by_file(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """``(path, rows)`` of every Parquet file below ``root`` that holds rows, whatever its columns: one scan that reads no column."""
    reader = spark.read.schema("unread boolean").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    return reader.parquet(root).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("rows"))


def require_sources(listing: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Required prefixes with their number of files and whether there is at least one.

    ``listing`` has a ``prefix`` column. The list of prefixes is configuration, one row each.
    """
    required = listing.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    found = listing.groupBy("prefix").agg(F.count("*").alias("files"))
    return required.join(found, "prefix", "left").select(
        "prefix",
        F.coalesce("files", F.lit(0)).alias("files"),
        F.coalesce(F.col("files") > 0, F.lit(False)).alias("present"),
    )


def file_inventory(listing: DataFrame, as_of) -> DataFrame:
    """Files, bytes, newest file, its age in hours and OK / WARN / MISSING for every prefix.

    ``as_of`` is a moment or a column that holds one.
    """
    moment = as_of if isinstance(as_of, Column) else as_timestamp(as_of)
    age = (F.unix_timestamp(moment) - F.unix_timestamp("latest")) / 3600
    return (
        listing.groupBy("prefix")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.max("modificationTime").alias("latest"))
        .withColumn("age_hours", F.round(age, 2))
        .withColumn(
            "status",
            F.when(F.col("age_hours") < FRESH_HOURS, "OK").when(F.col("age_hours") <= LATE_HOURS, "WARN").otherwise("MISSING"),
        )
    )
