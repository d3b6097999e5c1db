"""Writing tables. Every writer returns the path or table name so that callers can read back.

No writer squeezes its output into one file: the number of files follows the data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_snapshot(df: DataFrame, root: str, date) -> str:
    """Overwrite the snapshot of one date: ``root/YYYY-MM-DD``."""
    path = f"{root.rstrip('/')}/{date}"
    df.write.mode("overwrite").parquet(path)
    return path


def replace_table(df: DataFrame, table: str) -> str:
    """Empty an existing table and load it again; it keeps its definition. Creates it when missing."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        df.write.mode("overwrite").insertInto(table, overwrite=True)
    else:
        df.write.format("parquet").saveAsTable(table)
    return table


def land_idempotent(df: DataFrame, prefix: str) -> str:
    """Purge the prefix and write it again: running twice leaves one copy."""
    df.write.mode("overwrite").parquet(prefix)
    return prefix


def materialize_table(df: DataFrame, name: str, path: str | None = None) -> str:
    """Full rebuild of a table."""
    writer = df.write.format("parquet").mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return name


def land_append(df: DataFrame, prefix: str, epoch: int) -> str:
    """Append the files of one run below ``prefix/run=<epoch>``; the same run replaces itself."""
    df.write.mode("overwrite").parquet(f"{prefix.rstrip('/')}/run={epoch}")
    return prefix


def tsv_lines(df: DataFrame) -> DataFrame:
    """One ``line`` per row: tab separated, ``\\N`` for NULL, tabs and newlines in text blanked."""

    def cell(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            text = F.date_format(col, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DecimalType):
            text = F.regexp_replace(col.cast("string"), r"(\.\d+?)0+$", "$1")
        else:
            text = F.regexp_replace(col.cast("string"), "[\t\n]", " ")
        return F.coalesce(text, F.lit("\\N"))

    return df.select(F.concat_ws("\t", *[cell(f) for f in df.schema.fields]).alias("line"))


def write_tsv(df: DataFrame, path: str) -> str:
    tsv_lines(df).write.mode("overwrite").text(path)
    return path


def multi_sink(df: DataFrame, first_path: str, sinks: Sequence[Callable[[DataFrame], object]]) -> DataFrame:
    """Compute once, write to several sinks.

    The first sink is a Parquet path; all others read that written table, so a lost executor costs
    no recomputation and nothing is held in memory.
    """
    df.write.mode("overwrite").parquet(first_path)
    written = df.sparkSession.read.schema(df.schema).parquet(first_path)
    for sink in sinks:
        sink(written)
    return written


def write_clustered(df: DataFrame, path: str, keys: Sequence[str], part: str | None = None) -> str:
    """Partitioned by ``part`` and sorted by ``keys`` inside each file, so row-group statistics can skip.

    The rebalance hint gathers the rows of a partition value but lets adaptive execution split a
    value that holds much of the table over several writers.
    """
    shaped = df.hint("rebalance", part) if part else df.hint("rebalance")
    order = [part, *keys] if part else list(keys)
    writer = shaped.sortWithinPartitions(*order).write.mode("overwrite")
    (writer.partitionBy(part) if part else writer).parquet(path)
    return path


def read_back(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)
