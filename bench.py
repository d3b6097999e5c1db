"""Headline queries, timed. Prints one JSON line.

``build_*`` queries start from the given tables; ``serve_*`` queries read gold tables that were written
before, as a dashboard does. Every figure is the median of three runs after one warm-up, planning included.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stratalake.queries.catalogue import FUNCTIONS  # noqa: E402
from stratalake.queries.lake import Lake, shown  # noqa: E402
from stratalake.session import build_session, scratch_path  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 1)))
RUNS = 3

BUILD = [
    "fct1_orders", "fct2_procurement", "fct4_unified_customers", "agg1_daily_active_users", "win4_weekly_active_users",
    "scd2_history", "prf1_profile", "dq19_expectations_procurement", "txt1_tag_intent", "nn1_knn",
]
SERVE = [
    "agg25_order_count", "agg25_customer_count", "agg25_customers_by_segment", "agg25_orders_by_status", "agg25_monthly_amount",
    "agg25_top_spenders", "agg6_loyal_customers", "agg13_monthly_revenue_trend", "agg20_revenue_by_dimension",
    "top1_customers_by_spend", "dq7_referential_integrity", "dq19_expectations_orders", "met2_revenue_by_status_month",
]
STORED = [
    "bronze_customers", "bronze_orders", "stg_customers", "stg_orders", "stg_products", "stg_purchase_orders", "dim_customers",
    "dim_products", "dim_vendors", "fct_orders", "fct_procurement",
]



def once(function, lake: Lake) -> float:
    start = time.perf_counter()
    shown(function(lake)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(name: str, make_lake) -> float:
    once(FUNCTIONS[name], make_lake())
    return statistics.median(once(FUNCTIONS[name], make_lake()) for _ in range(RUNS))


def main() -> None:
    spark = build_session(
        f"local[{CPUS}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {f"build_{name}": timed(name, lambda: Lake(spark, SF_DIR)) for name in BUILD}
    start = time.perf_counter()
    gold = Lake(spark, SF_DIR).stored(scratch_path(spark, "gold"), STORED)
    times["build_gold_layer"] = time.perf_counter() - start
    times |= {f"serve_{name}": timed(name, lambda: gold) for name in SERVE}
    rounded = {name: round(seconds, 4) for name, seconds in times.items()}
    line = {"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": rounded, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
