"""Rule-based anomalies on daily series and run histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.neighbour_rows import last_seen
from stratalake.operators.opslog import with_duration

# Fixed values of the rules.
WEEKS, DEVIATION_PCT = 4, 25
DURATION_FACTOR, DURATION_DAYS = 2, 7
FAILURES_IN_A_ROW = 3
WEEKEND_DIP = (15, 30)


def weekday_anomaly(daily: DataFrame, day: str = "day", value: str = "value") -> DataFrame:
    """Each day against the mean of the same weekday in the four weeks before; flagged beyond 25%.

    The series holds one row per calendar day, so a weekday is a small group.
    """
    same_weekday = Window.partitionBy(F.dayofweek(day)).orderBy(day).rowsBetween(-WEEKS, -1)
    based = daily.withColumn("baseline", F.avg(value).over(same_weekday))
    deviation = F.round(F.try_divide((F.col(value) - F.col("baseline")) * 100.0, F.col("baseline")), 2)
    flagged = based.withColumn("deviation_pct", deviation)
    return flagged.withColumn("is_anomaly", F.coalesce(F.abs("deviation_pct") > DEVIATION_PCT, F.lit(False)))


def suppress_expected(anomalies: DataFrame, day: str = "day") -> DataFrame:
    """Mark flagged days that are no news: weekend dips of 15 to 30%, and a high first run of a month.

    The first run is the earliest day of the month that is present.
    """
    month = F.trunc(day, "month")
    first = anomalies.groupBy(month.alias("month")).agg(F.min(day).alias("first_day"))
    dip = -F.col("deviation_pct")
    weekend_dip = F.dayofweek(day).isin(1, 7) & dip.between(*WEEKEND_DIP)
    first_run = (F.col(day) == F.col("first_day")) & (F.col("deviation_pct") > 0)
    joined = anomalies.withColumn("month", month).join(first, "month")
    suppressed = F.col("is_anomaly") & F.coalesce(weekend_dip | first_run, F.lit(False))
    return joined.withColumn("suppressed", suppressed).drop("month", "first_day")


def duration_anomaly(runs: DataFrame) -> DataFrame:
    """Runs longer than twice the mean duration of the dag's runs in the seven days before.

    Durations, in whole tenths of minutes, are summed per dag and day first; the window runs over days,
    not over runs.
    """
    timed = with_duration(runs).filter(F.col("duration_min").isNotNull()).withColumn("day", F.to_date("start_date"))
    tenths = F.round(F.col("duration_min") * 10).cast("bigint")
    daily = timed.groupBy("dag_id", "day").agg(F.sum(tenths).alias("tenths"), F.count("*").alias("n"))
    days = daily.withColumn("day_no", F.unix_date("day"))
    before = Window.partitionBy("dag_id").orderBy("day_no").rangeBetween(-DURATION_DAYS, -1)
    mean = F.try_divide(F.sum("tenths").over(before), F.sum("n").over(before) * 10)
    baseline = days.select("dag_id", "day", mean.alias("mean_min"))
    joined = timed.join(baseline, ["dag_id", "day"])
    late = joined.filter(F.col("duration_min") > F.col("mean_min") * DURATION_FACTOR)
    return late.select("dag_id", "dag_run_id", "duration_min", "mean_min")


def failure_streaks(runs: DataFrame, least: int = FAILURES_IN_A_ROW) -> DataFrame:
    """Stretches of at least three failed runs in a row per dag.

    A failed run belongs to the stretch that began after the last run that did not fail. That moment is
    found in daily buckets, so a dag with very many runs is handled by many tasks.
    """
    started = F.col("start_date")
    fine = F.when(F.col("state") != "failed", started)
    marked = last_seen(runs, ["dag_id"], ["start_date", "dag_run_id"], fine, "last_fine", F.to_date("start_date"))
    failed = marked.filter(F.col("state") == "failed")
    streaks = failed.groupBy("dag_id", "last_fine").agg(
        F.count("*").alias("failures"), F.min("start_date").alias("first_failure"), F.max("start_date").alias("last_failure")
    )
    return streaks.filter(F.col("failures") >= least).drop("last_fine")


def failure_loops(tries: DataFrame, least: int = FAILURES_IN_A_ROW) -> DataFrame:
    """Tasks that failed three or more times in one run."""
    counted = tries.groupBy("run_id", "task_id").agg(F.count_if(F.col("state") == "failed").alias("failures"))
    return counted.filter(F.col("failures") >= least)
