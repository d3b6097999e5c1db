"""Operational logs: agent cost, slow queries, storage, runs, sync health, test results."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.dates import as_date, as_timestamp
from stratalake.functions.text import percent_of, readable_size, snippet
from stratalake.operators.dedup import first_n

# USD per token (0.11 and 0.34 per million), thresholds and job states.
INPUT_COST = Decimal("0.00000011")
OUTPUT_COST = Decimal("0.00000034")
COST = "decimal(10,6)"
HEALTHY_SYNC = ["succeeded", "running", "pending"]
SLA_MINUTES = 30
FAST_MS, SLOW_MS = 100, 1000
MONITOR_BYTES, ARCHIVE_BYTES = 500 * 1024**2, 1024**3
RESULT_STATES = {"pass": ["pass", "success"], "warn": ["warn"], "error": ["error", "fail"], "skip": ["skipped"]}


# ---- cost --------------------------------------------------------------------------------------------


def compute_cost(calls: DataFrame) -> DataFrame:
    """Input, output and total cost per call, exact decimals rounded to 6 places."""
    of = lambda tokens, price: F.col(tokens).cast("decimal(18,0)") * F.lit(price)
    spent_in, spent_out = of("input_tokens", INPUT_COST), of("output_tokens", OUTPUT_COST)
    places = lambda c: F.round(c, 6).cast(COST)
    return calls.withColumns(
        {"input_cost": places(spent_in), "output_cost": places(spent_out), "total_cost": places(spent_in + spent_out)}
    )


def _last_days(calls: DataFrame, days: int, as_of) -> DataFrame:
    return calls.filter(F.col("created_at") >= as_timestamp(as_of) - F.make_dt_interval(F.lit(days)))


def _totals() -> list[Column]:
    return [
        F.count("*").alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.sum("total_cost").alias("total_cost"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    ]


def daily_costs(calls: DataFrame, days: int, as_of) -> DataFrame:
    priced = compute_cost(_last_days(calls, days, as_of))
    return priced.groupBy(F.to_date("created_at").alias("day"), "agent").agg(*_totals())


def cost_summary(calls: DataFrame, days: int, as_of) -> DataFrame:
    """Grand total (agent NULL) and one row per agent, in one pass."""
    priced = compute_cost(_last_days(calls, days, as_of))
    grouped = priced.groupingSets([[], [F.col("agent")]], F.col("agent"))
    return grouped.agg(*_totals(), F.min("created_at").alias("first_call"), F.max("created_at").alias("last_call"))


def cost_pivot(calls: DataFrame, agents: Sequence[str]) -> DataFrame:
    """One column per agent and one row per day, 0 where an agent had no call."""
    priced = compute_cost(calls).groupBy(F.to_date("created_at").alias("day"))
    return priced.pivot("agent", list(agents)).agg(F.sum("total_cost").cast("double")).fillna(0.0, subset=list(agents))


def cost_share(calls: DataFrame) -> DataFrame:
    """Percent of the total cost per agent."""
    by_agent = compute_cost(calls).groupBy("agent").agg(F.sum("total_cost").cast("double").alias("total_cost"))
    whole = by_agent.agg(F.sum("total_cost").alias("whole")).scalar()
    share = F.round(F.coalesce(F.try_divide(F.col("total_cost"), whole) * 100, F.lit(0.0)), 4)
    return by_agent.withColumn("share_pct", share)


def recent(df: DataFrame, n: int, ts: str, *ties: str) -> DataFrame:
    """The newest ``n`` rows."""
    return df.orderBy(F.desc(ts), *[F.desc(t) for t in ties]).limit(n)


INCIDENT = ["entity", "problem", "action_taken", "resolved", "created_at"]


def recent_incidents(incidents: DataFrame, n: int = 10) -> DataFrame:
    """The newest incidents, resolved or not; those of one moment by id, the later first."""
    return recent(incidents, n, "created_at", "id").select(*INCIDENT)


def open_incidents(incidents: DataFrame) -> DataFrame:
    """Per entity: unresolved incidents, the newest of them and its problem."""
    last = F.struct("created_at", "id", "problem")
    grouped = incidents.filter(~F.col("resolved")).groupBy("entity").agg(F.count("*").alias("unresolved"), F.max(last).alias("last"))
    return grouped.select("entity", "unresolved", F.col("last.created_at").alias("last_at"), F.col("last.problem").alias("last_problem"))


# ---- queries and storage -----------------------------------------------------------------------------


def speed_band(ms: Column) -> Column:
    return F.when(ms < FAST_MS, "FAST").when(ms <= SLOW_MS, "ACCEPTABLE").otherwise("SLOW")


def slow_queries(log: DataFrame, as_of, ms: int = SLOW_MS, n: int = 5) -> DataFrame:
    """Finished queries of the day above a duration, slowest first."""
    today = (F.to_date("event_time") == as_date(as_of)) & (F.col("type") == "QueryFinish") & (F.col("query_duration_ms") > ms)
    shown = log.filter(today).select(
        "query_id",
        "query_duration_ms",
        "read_rows",
        readable_size(F.col("memory_usage")).alias("memory"),
        snippet(F.col("query"), 100).alias("query_snippet"),
        speed_band(F.col("query_duration_ms")).alias("band"),
    )
    return shown.orderBy(F.desc("query_duration_ms"), "query_id").limit(n)


def slow_initial_queries(log: DataFrame, as_of, hours: int = 1, ms: int = 500, n: int = 10) -> DataFrame:
    """Finished top-level queries of the last hours above a duration, slowest first."""
    end = as_timestamp(as_of)
    window = (F.col("event_time") >= end - F.make_dt_interval(F.lit(0), F.lit(hours))) & (F.col("event_time") <= end)
    hits = log.filter(window & (F.col("type") == "QueryFinish") & (F.col("is_initial_query") == 1) & (F.col("query_duration_ms") > ms))
    shown = hits.select(
        "query_id",
        F.round(F.col("query_duration_ms") / 1000.0, 2).cast("double").alias("seconds"),
        readable_size(F.col("read_bytes")).alias("bytes_read"),
        "read_rows",
    )
    return shown.orderBy(F.desc("seconds"), "query_id").limit(n)


def storage_report(sizes: DataFrame) -> DataFrame:
    """Stored and raw bytes per table with their ratio and band; rows are (table_name, stored, raw)."""
    totals = sizes.groupBy("table_name").agg(F.sum("stored").alias("stored"), F.sum("raw").alias("raw"))
    band = F.when(F.col("stored") < MONITOR_BYTES, "OK").when(F.col("stored") <= ARCHIVE_BYTES, "MONITOR").otherwise("ARCHIVE")
    return totals.select(
        "table_name",
        "stored",
        "raw",
        readable_size(F.col("stored")).alias("stored_size"),
        readable_size(F.col("raw")).alias("raw_size"),
        percent_of(F.col("stored").cast("double"), F.greatest(F.col("raw"), F.lit(1))).alias("ratio_pct"),
        band.alias("band"),
    )


# ---- runs --------------------------------------------------------------------------------------------


def with_duration(runs: DataFrame) -> DataFrame:
    """Duration in minutes, one decimal, from whole seconds; NULL while a run has no end."""
    seconds = F.unix_timestamp("end_date") - F.unix_timestamp("start_date")
    return runs.withColumn("duration_min", F.round(seconds / 60.0, 1).cast("double"))


def run_history(runs: DataFrame, n: int = 30) -> DataFrame:
    """The newest ``n`` runs per dag with state and duration."""
    newest = first_n(runs, ["dag_id"], [F.desc("start_date"), F.desc("dag_run_id")], n)
    return with_duration(newest).select("dag_id", "dag_run_id", "state", "start_date", "duration_min")


def sla_misses(runs: DataFrame, minutes: int = SLA_MINUTES) -> DataFrame:
    late = with_duration(runs).filter(F.col("duration_min") > minutes)
    return late.select("dag_id", "dag_run_id", "duration_min")


def sync_health(connections: DataFrame, jobs: DataFrame) -> DataFrame:
    """Connections whose newest job did not succeed and is not under way, or that have no job."""
    newest = jobs.groupBy("connection_id").agg(
        F.max_by(F.struct("job_id", "status"), F.struct("started_at", "job_id")).alias("job")
    )
    joined = connections.join(newest, "connection_id", "left").select(
        "connection_id", "name", F.col("job.job_id").alias("job_id"), F.col("job.status").alias("status")
    )
    problem = F.when(F.col("job_id").isNull(), "no job history").when(~F.col("status").isin(*HEALTHY_SYNC), "failed")
    return joined.withColumn("problem", problem).filter(F.col("problem").isNotNull())


def tally_results(documents: DataFrame, keys: Sequence[str] = (), json: str = "json") -> DataFrame:
    """Test results by outcome from JSON documents with a ``results`` list of ``{"status": ...}``."""
    schema = T.StructType([T.StructField("results", T.ArrayType(T.StructType([T.StructField("status", T.StringType())])))])
    results = documents.select(*keys, F.explode(F.from_json(json, schema)["results"]).alias("result"))
    state = F.col("result.status")
    counted = results.groupBy(*keys).agg(*[F.count_if(state.isin(*v)).alias(k) for k, v in RESULT_STATES.items()])
    return counted.withColumn("total", sum((F.col(k) for k in RESULT_STATES), F.lit(0)))
