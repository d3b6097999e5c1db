"""Reading the given tables, storing intermediate ones, and helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import prepare, scratch_path

#: Rows of a batch that goes to Python; texts can be long, so batches are kept small.
BATCH_ROWS = "500"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ready(spark: SparkSession) -> SparkSession:
    """Settings that every query of this subpackage runs under."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read from there: later steps neither repeat the work nor depend on executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z, every other character as it is (``lower`` would also change accented letters)."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that the table does not have yet, whatever the case of its letters."""
    taken = {name.lower() for name in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish
