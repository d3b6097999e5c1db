"""Histories that persist: every run lands its rows and reads what earlier runs landed.

A run writes the folder of its own date and nothing else, so running a day again replaces that day's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.dates import as_date
from stratalake.operators.quality import observability

RUN = "run_date"


def start_history(spark: SparkSession, path: str, schema: str) -> str:
    """An empty history at ``path`` if there is none yet; ``schema`` names the columns besides the run's date."""
    empty = spark.createDataFrame([], f"{schema}, {RUN} date")
    empty.write.mode("ignore").parquet(path)
    return path


def append_run(rows: DataFrame, path: str, run_date: str) -> DataFrame:
    """Land the rows of a run (without its date); returns them as read back."""
    folder = f"{path}/{RUN}={run_date}"
    rows.drop(RUN).write.mode("overwrite").parquet(folder)
    spark = rows.sparkSession
    return spark.read.schema(rows.drop(RUN).schema).parquet(folder).withColumn(RUN, as_date(run_date))


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All runs that have landed; filters on the date prune folders."""
    return spark.read.schema(f"{schema}, {RUN} date").parquet(path)


OBSERVED = "pipeline string, table_name string, row_count bigint, prev_count bigint, delta_pct double, status string"


def observe_run(counts: DataFrame, path: str, run_date: str) -> DataFrame:
    """Compare the counts of a run (pipeline, table_name, row_count) with the latest stored run before it, and land the outcome."""
    spark = counts.sparkSession
    start_history(spark, path, OBSERVED)
    seen = observability(read_history(spark, path, OBSERVED), counts, run_date)
    return append_run(seen.select("pipeline", "table_name", "row_count", "prev_count", "delta_pct", "status"), path, run_date)


def latest_runs(history: DataFrame, n: int) -> DataFrame:
    """Rows of the ``n`` newest run dates."""
    dates = history.select(RUN).distinct().orderBy(F.desc(RUN)).limit(n)
    return history.join(dates, RUN)
