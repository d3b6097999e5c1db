"""The physical plans are the ones that survive large and skewed data."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from stratalake.operators import profiling, quality
from stratalake.operators.dedup import dedup_latest
from stratalake.operators.integrity import orphans
from stratalake.operators.scd import scd2_history
from stratalake.plans import marts, suites
from stratalake.queries import checks
from stratalake.queries.lake import Lake
from stratalake.queries.models import _tables
from stratalake.plans import semantic
from stratalake.session import scratch_path
from stratalake.operators.tagging import tag_intent

LIBRARY = pathlib.Path(__file__).parent.parent / "stratalake"


@pytest.fixture(scope="module")
def lake(spark, sf_dir):
    return Lake(spark, sf_dir)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_is_cut_before_the_shuffle(lake):
    text = plan(dedup_latest(lake.customer_changes, ["customer_id"], ["updated_at", "lsn"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning(customer_id") < text.index("Partial")


def test_a_suite_scans_its_table_once(lake):
    rules = suites.suite("s", suites.not_null("o_orderkey", "o_custkey"), suites.between("o_totalprice", 0), suites.in_set("o_orderstatus", ["F"]))
    text = plan(quality.validate(lake.table("orders"), rules))
    assert text.count("FileScan") == 1
    assert "o_orderpriority" not in text


def test_a_profile_reads_its_table_once_per_kind(lake):
    df = lake.table("lineitem").select("l_orderkey", "l_quantity", "l_discount")
    assert plan(profiling.profile(df, "lineitem")).count("FileScan") == 1
    assert plan(profiling.profile_stats(df)).count("FileScan") == 1


def test_time_filters_reach_the_scan(lake):
    recent = lake.table("orders").filter(F.col("o_orderdate") >= "2001-07-01").select("o_orderkey")
    assert "GreaterThanOrEqual(o_orderdate" in plan(recent)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan(recent)


def test_facts_join_on_the_natural_key(lake):
    text = plan(lake.fct_orders)
    joins = [line for line in text.splitlines() if re.search(r"(SortMerge|Hash)Join", line)]
    assert joins and not any("_key" in line for line in joins)


def test_no_join_without_a_key(lake):
    for df in (lake.unified, lake.fct_procurement, marts.funnel_pct(lake.fct_funnel), tag_intent(lake.messages)):
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan(df))


def test_intents_need_no_shuffle(lake):
    assert "Exchange" not in plan(tag_intent(lake.messages))


def test_orphans_are_counted_per_key_first(spark, lake):
    """Unless the parents can be broadcast, in which case there is no shuffle of the children at all."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        check_orphans(lake)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def check_orphans(lake):
    text = plan(orphans(lake.table("lineitem"), lake.table("supplier"), "l_suppkey", "s_suppkey"))
    assert "LeftAnti" in text and "NullAware" not in text
    assert text.index("LeftAnti") < text.index("partial_count")


def test_rows_are_aggregated_before_a_dimension_is_joined(lake):
    fact = lake.table("orders").select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("revenue"), F.col("o_orderkey").alias("order_id"))
    text = plan(marts.fct_clv_by_segment(fact, lake.dim_customers))
    join = re.search("(SortMerge|Hash)Join", text).start()
    assert text.index("partial_sum(revenue", join) > join  # an aggregate below the join


def test_the_procurement_fact_is_not_shuffled_for_its_vendors(lake):
    text = plan(lake.with_dimensions("dim_vendors").fct_procurement)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "Exchange hashpartitioning(vendor_id" not in text


def test_all_metrics_aggregate_each_table_once(lake):
    tables = {n: lake.table("orders") for n in ("fct_orders", "dim_customers", "stg_subscriptions", "stg_events")}
    names = {"fct_orders": "revenue order_id", "dim_customers": "customer_key is_current", "stg_subscriptions": "mrr user_id", "stg_events": "user_id"}
    shaped = {n: df.select(*[F.col("o_orderkey").alias(c) for c in names[n].split()]) for n, df in tables.items()}
    assert plan(semantic.all_metrics(shaped)).count("FileScan") == 4


def test_scd2_history_reads_its_input_once(lake):
    changes = lake.table("orders").select(F.col("o_custkey").alias("id"), "o_orderstatus", F.col("o_orderdate").cast("timestamp").alias("ts"), "o_orderkey")
    assert plan(scd2_history(changes, "id", ["o_orderstatus"], "ts", "o_orderkey")).count("FileScan") == 1


def test_metrics_read_only_what_they_need(lake):
    text = plan(semantic.query_metric(_tables(lake), "dau", [], "day"))
    assert "props" not in text.split("FileScan")[1].split("Batched")[0]


#: The subpackage for training text fits models on bounded samples and has rules of its own.
SOURCES = sorted(p for p in LIBRARY.rglob("*.py") if p.relative_to(LIBRARY).parts[0] != "llm")


@pytest.mark.parametrize("path", SOURCES, ids=lambda p: str(p.relative_to(LIBRARY)))
def test_library_rules(path):
    """No collected tables, no local checkpoints, no cross joins, no clock."""
    source = path.read_text()
    for forbidden in (".collect()", "localCheckpoint", "crossJoin", "datetime.now", "current_timestamp", ".rdd", "coalesce(1)", "tojson()", ".toPandas()"):
        assert forbidden not in source, forbidden


def test_a_stored_lake_keeps_its_tables(lake, spark):
    from stratalake.session import scratch_path

    served = lake.stored(scratch_path(spark, "gold"), ["dim_products", "dim_customers", "fct_orders"])
    again = served.with_dimensions("dim_customers", "dim_vendors")
    assert set(again.written) == {"dim_products", "dim_customers", "fct_orders", "dim_vendors"}
    assert plan(again.fct_orders).count("FileScan") == 1 and "lineitem" not in plan(again.fct_orders)
    assert not lake.written


def test_row_counts_of_files_read_no_column(lake, spark):
    from stratalake.sources import files

    text = plan(files.rows_by_file(spark, lake.dir))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<>" in text


def test_marts_are_tested_without_writing_the_purchase_orders(lake):
    assert "fct_procurement" not in checks.SHARED
    stored = lake.stored(scratch_path(lake.spark, "shared"), ["dim_customers", "dim_products", "fct_orders"], {"fct_orders": checks.ORDER_COLUMNS})
    assert stored.fct_orders.columns == checks.ORDER_COLUMNS and stored.fct_orders.count() == lake.fct_orders.count()
