"""Data quality, profiles, contracts, governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.operators import contracts, frequent, governance, history, integrity, profiling, quality, schema_census
from stratalake.plans import marts, suites
from stratalake.queries.registry import query
from stratalake.session import scratch_path
from stratalake.sources.driver_tables import EVENTS_AS_OF, ORDERS_AS_OF, QUERY_LOG_AS_OF, SCHEMAS

# ---- fixed checks ------------------------------------------------------------------------------------


def _violations(condition) -> tuple:
    return F.count_if(condition), 0


def _dq1(t):
    count = F.count("*")
    blank = lambda c: F.col(c).isNull() | (F.col(c) == "")
    return quality.quality_checks(
        {
            "dim_customers": (
                t.dim_customers,
                {"gold.dim_customers": (count, 100), "dim_customers.is_current": _violations(F.col("is_current") != 1)},
            ),
            "dim_products": (t.dim_products, {"gold.dim_products": (count, 10)}),
            "dim_vendors": (t.dim_vendors, {"gold.dim_vendors": (count, 1)}),
            "fct_orders": (
                t.fct_orders,
                {
                    "gold.fct_orders": (count, 100),
                    "fct_orders.customer_key nulls": _violations(blank("customer_key")),
                    "fct_orders.product_key nulls": _violations(blank("product_key")),
                    "fct_orders.revenue consistency": _violations((F.col("status") == "completed") & (F.col("revenue") <= 0)),
                },
            ),
            "fct_procurement": (t.fct_procurement, {"gold.fct_procurement": (count, 1)}),
            "fct_reviews": (t.fct_reviews, {"gold.fct_reviews": (count, 1)}),
        }
    )


def _rule_sql(name: str, table: str, expected: int, condition: str | None = None) -> str:
    where = f" WHERE {condition}" if condition else ""
    test = f"count(*) >= {expected}" if expected else "count(*) = 0"
    return f"SELECT '{name}' AS \"check\", count(*) AS value, CAST({expected} AS BIGINT) AS expected, {test} AS ok FROM {table}{where}"


query(
    "dq1_quality_checks",
    " UNION ALL ".join(
        [
            _rule_sql("gold.dim_customers", "dim_customers", 100),
            _rule_sql("gold.dim_products", "dim_products", 10),
            _rule_sql("gold.dim_vendors", "dim_vendors", 1),
            _rule_sql("gold.fct_orders", "fct_orders", 100),
            _rule_sql("gold.fct_procurement", "fct_procurement", 1),
            _rule_sql("gold.fct_reviews", "fct_reviews", 1),
            _rule_sql("fct_orders.customer_key nulls", "fct_orders", 0, "customer_key IS NULL OR customer_key = ''"),
            _rule_sql("fct_orders.product_key nulls", "fct_orders", 0, "product_key IS NULL OR product_key = ''"),
            _rule_sql("fct_orders.revenue consistency", "fct_orders", 0, "status = 'completed' AND revenue <= 0"),
            _rule_sql("dim_customers.is_current", "dim_customers", 0, "is_current <> 1"),
        ]
    ),
)(_dq1)

GOLD = ["fct_orders", "fct_procurement", "fct_reviews", "dim_customers", "dim_products", "dim_vendors"]
query("dq2_row_counts", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in GOLD))(
    lambda t: quality.row_counts(t.gold_tables)
)
query(
    "dq2_row_count_anomaly",
    """SELECT run_date, pipeline, table_name, row_count, mean_count, coalesce(abs(row_count - mean_count) > mean_count * 0.5, false)
      AS is_anomaly FROM (SELECT *, avg(row_count) OVER (PARTITION BY pipeline, table_name ORDER BY run_date
      ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS mean_count FROM table_counts)""",
)(lambda t: quality.row_count_anomaly(t.table_counts))


def _dq3(t):
    """Counts of the last day against the day before."""
    counts = t.table_counts
    current = counts.filter(F.col("run_date") == "2024-01-30").select("pipeline", "table_name", "row_count")
    return quality.observability(counts, current, "2024-01-30")


OBSERVED = """SELECT run_date, pipeline, table_name, row_count, prev_count, delta_pct,
  CASE WHEN prev_count > 0 AND delta_pct < -25 THEN 'anomaly' ELSE 'ok' END AS status
  FROM (SELECT *, round(CAST(row_count - prev_count AS DOUBLE) / greatest(prev_count, 1) * 100, 2) AS delta_pct FROM (SELECT
    DATE '2024-01-30' AS run_date, c.pipeline, c.table_name, c.row_count, coalesce(p.row_count, c.row_count) AS prev_count
    FROM (SELECT * FROM table_counts WHERE run_date = DATE '2024-01-30') c LEFT JOIN (SELECT * FROM table_counts
      WHERE run_date < DATE '2024-01-30' QUALIFY row_number() OVER (PARTITION BY pipeline, table_name ORDER BY run_date DESC) = 1) p
    ON c.pipeline = p.pipeline AND c.table_name = p.table_name))"""
query("dq3_observability", OBSERVED)(_dq3)


def _dq3_stored(t):
    """Four runs against one stored history: three days, the last of them twice."""
    path = scratch_path(t.spark, "observability")
    for day in ("2024-01-28", "2024-01-29", "2024-01-30", "2024-01-30"):
        counts = t.table_counts.filter(F.col("run_date") == day).select("pipeline", "table_name", "row_count")
        history.observe_run(counts, path, day)
    return history.read_history(t.spark, path, history.OBSERVED)


query(
    "dq3_stored_history",
    """SELECT run_date, pipeline, table_name, row_count, prev_count, delta_pct, CASE WHEN prev_count > 0 AND delta_pct < -25 THEN 'anomaly' ELSE 'ok' END AS status
      FROM (SELECT *, round(CAST(row_count - prev_count AS DOUBLE) / greatest(prev_count, 1) * 100, 2) AS delta_pct FROM
        (SELECT run_date, pipeline, table_name, row_count, coalesce(lag(row_count) OVER (PARTITION BY pipeline, table_name ORDER BY run_date), row_count) AS prev_count
         FROM table_counts WHERE run_date BETWEEN DATE '2024-01-28' AND DATE '2024-01-30'))""",
)(_dq3_stored)
query(
    "win7_previous_run",
    """SELECT run_date, pipeline, table_name, row_count, lag(row_count) OVER (PARTITION BY pipeline, table_name ORDER BY run_date) AS prev_count
      FROM table_counts""",
)(lambda t: quality.previous_runs(t.table_counts))

CHECKED = [
    ("fct_orders", "customer_key"), ("fct_orders", "product_key"), ("fct_orders", "order_date_day"), ("fct_orders", "revenue"),
    ("dim_customers", "email"), ("dim_customers", "segment"), ("fct_procurement", "vendor_key"), ("fct_procurement", "amount"),
]


def _null_checks(t, extra=()):
    wanted: dict = {}
    for table, column in [*CHECKED, *extra]:
        wanted.setdefault(table, (t.gold_tables[table], []))[1].append(column)
    return wanted


def _null_sql(table: str, column: str, condition: str) -> str:
    rate = f"CAST(count(*) FILTER ({condition}) AS DOUBLE) / count(*)"
    return f"SELECT '{table}' AS table_name, '{column}' AS column_name, {rate} AS null_rate, {rate} <= 0.001 AS ok FROM {table}"


query("dq4_null_rates", " UNION ALL ".join(_null_sql(a, b, f"{b} IS NULL") for a, b in CHECKED))(
    lambda t: quality.null_rates(_null_checks(t))
)
query(
    "dq4_null_or_empty_rates",
    " UNION ALL ".join(
        _null_sql(a, b, f"{b} IS NULL OR CAST({b} AS VARCHAR) = ''") for a, b in [*CHECKED, ("dim_customers", "phone")]
    ),
)(lambda t: quality.null_rates(_null_checks(t, [("dim_customers", "phone")]), blank_is_null=True))
# All columns of the two tables that are profiled and reported on.
CUSTOMERS = {
    "customer_key": "string", "customer_id": "bigint", "first_name": "string", "last_name": "string", "full_name": "string", "email": "string",
    "phone": "string", "segment": "string", "country": "string", "city": "string", "updated_at": "timestamp", "days_since_signup": "int",
    "version": "bigint", "valid_from": "timestamp", "valid_to": "timestamp", "is_current": "int",
}
ORDERS = {
    "order_id": "bigint", "customer_key": "string", "product_key": "string", "customer_id": "bigint", "product_id": "bigint", "amount": "decimal(18,2)",
    "quantity": "int", "revenue": "decimal(18,2)", "status": "string", "order_date": "timestamp", "order_date_day": "date", "order_month": "date",
    "order_year": "int", "updated_at": "timestamp", "customer_segment": "string", "customer_country": "string", "product_category": "string",
    "product_price_tier": "string", "product_name": "string",
}


def _is_number(dtype: str) -> bool:
    return dtype in ("bigint", "int", "double") or dtype.startswith("decimal")


def _report_sql(c: str) -> str:
    return f"""SELECT '{c}' AS column_name, pct AS null_pct, CASE WHEN pct = 0 THEN 'OK' WHEN pct <= 1 THEN 'WARN' ELSE 'HIGH' END AS status
      FROM (SELECT round(count(*) FILTER ({c} IS NULL OR CAST({c} AS VARCHAR) = '') * CAST(100.0 AS DOUBLE) / count(*), 2) AS pct FROM dim_customers)"""


query("dq5_null_rate_report", " UNION ALL ".join(_report_sql(c) for c in CUSTOMERS))(
    lambda t: quality.null_rate_report(t.dim_customers)
)
query(
    "dq6_duplicate_count",
    """SELECT count(*) AS total, count(DISTINCT po) AS uniq, count(*) - count(DISTINCT po) AS duplicates
      FROM (SELECT l_orderkey || '-' || l_linenumber AS po FROM lineitem)""",
)(
    lambda t: quality.duplicate_count(
        t.table("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("po")), "po"
    )
)


def _references(t):
    return [
        integrity.Reference("fct_orders customer keys in dim_customers", t.fct_orders, t.dim_customers, "customer_id"),
        integrity.Reference("fct_orders product keys in dim_products", t.fct_orders, t.dim_products, "product_id"),
        integrity.Reference("fct_procurement vendor keys in dim_vendors", t.fct_procurement, t.dim_vendors, "vendor_id"),
    ]


INTEGRITY = " UNION ALL ".join(
    f"""SELECT '{f} {k} keys in {d}' AS "check", count(*) AS orphans, count(*) = 0 AS ok FROM {f} a
      WHERE NOT EXISTS (SELECT 1 FROM {d} b WHERE a.{k}_key = b.{k}_key)"""
    for f, k, d in [("fct_orders", "customer", "dim_customers"), ("fct_orders", "product", "dim_products"), ("fct_procurement", "vendor", "dim_vendors")]
)
query("dq7_referential_integrity", INTEGRITY)(lambda t: integrity.referential_integrity(_references(t)))
query("dq9_referential_integrity_exists", INTEGRITY)(lambda t: integrity.referential_integrity(_references(t), exists_form=True))


def _fresh(t):
    daily = (25, 49)
    return quality.freshness(
        {
            "src_mysql_customers": (t.bronze_customers, "_airbyte_extracted_at", *daily),
            "src_mysql_orders": (t.bronze_orders, "_airbyte_extracted_at", *daily),
            "src_mysql_products": (t.bronze_products, "_airbyte_extracted_at", *daily),
            "products_enriched": (t.products_enriched, "enriched_at", 1, 3),
        },
        ORDERS_AS_OF,
    )


def _fresh_sql(name: str, table: str, ts: str, warn: int, error: int) -> str:
    return f"""SELECT '{name}' AS table_name, newest, age_hours, CASE WHEN age_hours > {error} THEN 'error' WHEN age_hours > {warn} THEN
      'warn' ELSE 'pass' END AS status FROM (SELECT max({ts}) AS newest, round(CAST(epoch(TIMESTAMP '2001-08-01') -
      epoch(max({ts})) AS DOUBLE) / 3600, 2) AS age_hours FROM {table})"""


query(
    "dq8_freshness",
    " UNION ALL ".join(
        [_fresh_sql(f"src_mysql_{n}", f"bronze_{n}", "_airbyte_extracted_at", 25, 49) for n in ("customers", "orders", "products")]
        + [_fresh_sql("products_enriched", "products_enriched", "enriched_at", 1, 3)]
    ),
)(_fresh)

# ---- assertions: no row means the rule holds -----------------------------------------------------------

query("dq10_dau_non_negative", "SELECT event_date, dau, total_events FROM fct_dau WHERE dau < 0 OR total_events < 0")(
    lambda t: quality.assert_dau_non_negative(t.fct_dau)
)
query(
    "dq11_one_current",
    """SELECT customer_id, count(*) AS current_count FROM customer_changes GROUP BY 1 HAVING count(*) > 1""",
)(lambda t: quality.assert_one_current(t.customer_changes.withColumn("is_current", F.lit(1))))
query(
    "dq12_revenue_consistency",
    "SELECT order_id, status, CAST(amount AS DOUBLE) AS amount, CAST(revenue AS DOUBLE) AS revenue FROM fct_orders WHERE status = 'completed' AND revenue <= 0",
)(lambda t: quality.assert_revenue_consistency(t.fct_orders))
query(
    "dq13_procurement_amount_positive",
    "SELECT po_id, vendor_id, status, currency, CAST(amount AS DOUBLE) AS amount FROM fct_procurement WHERE amount <= 0",
)(lambda t: quality.assert_positive(t.fct_procurement, "amount", "po_id", "vendor_id", "status", "currency"))
query(
    "dq14_mrr_non_negative",
    "SELECT subscription_id, user_id, plan, status, mrr FROM stg_subscriptions WHERE mrr < 0",
)(lambda t: quality.assert_non_negative(t.stg_subscriptions, "mrr", "subscription_id", "user_id", "plan", "status"))
query(
    "dq15_no_future_orders",
    "SELECT order_id, status, order_date FROM stg_orders WHERE order_date > TIMESTAMP '2001-07-01'",
)(lambda t: quality.assert_no_future(t.stg_orders, "order_date", "2001-07-01", "order_id", "status"))
query("dq16_order_amount_positive", "SELECT order_id, status, CAST(amount AS DOUBLE) AS amount FROM stg_orders WHERE amount <= 0")(
    lambda t: quality.assert_positive(t.stg_orders, "amount", "order_id", "status")
)

# ---- declared tests ------------------------------------------------------------------------------------


def _test_sql(tests: dict, rename: dict[str, str] | None = None) -> str:
    """One counting statement per declared test."""
    table_of = lambda n: (rename or {}).get(n, n)
    parts = []
    for table, columns in tests.items():
        for column, rules in columns.items():
            for rule in rules:
                kind, arg = (rule, None) if isinstance(rule, str) else next(iter(rule.items()))
                if kind == "unique":
                    count, where = f"count({column}) - count(DISTINCT {column})", ""
                elif kind == "not_null":
                    count, where = "count(*)", f"WHERE {column} IS NULL"
                elif kind == "accepted_values":
                    listed = ", ".join(repr(v) for v in arg)
                    count, where = "count(*)", f"WHERE {column} NOT IN ({listed})"
                else:
                    parent, parent_column = arg
                    count = "count(*)"
                    where = f"WHERE {column} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {table_of(parent)} p WHERE p.{parent_column} = c.{column})"
                parts.append(
                    f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS test, {count} AS failures FROM {table_of(table)} c {where}"
                )
    return "\nUNION ALL ".join(parts)


def _only(*tables: str) -> dict:
    return {n: suites.SCHEMA_TESTS[n] for n in tables}


SILVER_TESTS = _only("stg_customers", "stg_orders", "stg_products", "stg_vendors", "stg_purchase_orders", "stg_reviews")
GOLD_TESTS = _only("dim_customers", "dim_products", "dim_vendors", "fct_orders", "fct_procurement", "fct_reviews")
SAAS_TESTS = _only("stg_users", "stg_events", "stg_subscriptions", "dim_users", "fct_daily_active_users", "fct_event_funnel")
SAAS_NAMES = {"fct_daily_active_users": "fct_dau", "fct_event_funnel": "fct_funnel"}

query("dq17_schema_tests_silver", _test_sql(SILVER_TESTS))(
    lambda t: quality.run_schema_tests({n: getattr(t, n) for n in SILVER_TESTS}, SILVER_TESTS)
)
query("dq17_schema_tests_gold", _test_sql(GOLD_TESTS))(
    lambda t: quality.run_schema_tests({n: getattr(t, n) for n in GOLD_TESTS}, GOLD_TESTS)
)
query("dq17_schema_tests_saas", _test_sql(SAAS_TESTS, SAAS_NAMES))(
    lambda t: quality.run_schema_tests({n: getattr(t, SAAS_NAMES.get(n, n)) for n in SAAS_TESTS}, SAAS_TESTS)
)


def _marts(t):
    return {
        "fct_mrr": t.fct_mrr,
        "fct_weekly_active_users": marts.fct_weekly_active_users(t.stg_subscriptions),
        "fct_top_customers_by_spend": marts.fct_top_customers_by_spend(t.fct_orders, t.dim_customers),
        "fct_customer_journey": marts.fct_customer_journey(t.dim_users, t.unified),
        "fct_loyal_customers": marts.fct_loyal_customers(t.fct_orders, t.dim_customers),
        "fct_mrr_by_plan": marts.fct_mrr_by_plan(t.fct_mrr),
        "fct_monthly_revenue_trend_by_category": marts.fct_monthly_revenue_trend(t.fct_orders, ORDERS_AS_OF),
        "fct_rolling_revenue_by_category": marts.fct_rolling_revenue_by_category(t.fct_orders, ORDERS_AS_OF),
        "fct_customer_lifetime_value_by_segment": marts.fct_clv_by_segment(t.fct_orders, t.dim_customers),
        "fct_vendor_performance": marts.fct_vendor_performance(t.fct_procurement, t.dim_vendors),
        "mart_product_enrichment": t.mart_enrichment,
        "fct_revenue_by_category": marts.fct_revenue_by_category(t.fct_orders),
        "fct_customer_churn_rate": marts.fct_customer_churn_rate(t.stg_subscriptions),
        "fct_monthly_revenue_by_category": marts.fct_monthly_revenue_by_category(t.fct_orders, t.dim_products),
        "fct_revenue_by_plan": marts.fct_revenue_by_plan(t.stg_subscriptions),
    }


CATEGORY_DAYS = """SELECT count(*) AS failures FROM (SELECT product_category, order_date_day FROM fct_orders
  WHERE product_category IS NULL GROUP BY 1, 2)"""


def _mart_sql() -> str:
    """All rules hold but those on the category of products that are missing from the dimension."""
    failing = {
        ("fct_revenue_by_category", "product_category"): f"({CATEGORY_DAYS})",
        ("fct_rolling_revenue_by_category", "product_category"): """(SELECT count(*) FROM (SELECT product_category FROM fct_orders
          WHERE status = 'completed' AND order_date_day >= DATE '2001-08-01' - 30 AND product_category IS NULL GROUP BY 1))""",
        ("fct_monthly_revenue_trend_by_category", "category"): """(SELECT count(*) FROM (SELECT order_month FROM fct_orders
          WHERE order_date >= DATE '2001-08-01' - 180 AND product_category IS NULL GROUP BY 1))""",
    }
    rows = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, 'not_null' AS test, CAST({failing.get((t, c), 0)} AS BIGINT) AS failures"
        for t, columns in suites.MART_TESTS.items()
        for c in columns
    ]
    return "\nUNION ALL ".join(rows)


# What several marts are built on, in dependency order; written once for all of them. Purchase orders are read by one mart only.
SHARED = ["stg_subscriptions", "dim_customers", "dim_products", "dim_vendors", "dim_users", "fct_orders"]
# The columns that the marts read of the orders.
ORDER_COLUMNS = ["order_id", "customer_id", "product_id", "revenue", "status", "order_date", "order_date_day", "product_category"]


def _dq17_marts(t):
    stored = t.stored(scratch_path(t.spark, "shared"), SHARED, {"fct_orders": ORDER_COLUMNS})
    return quality.run_schema_tests(_marts(stored), suites.MART_TESTS)


query("dq17_schema_tests_marts", _mart_sql())(_dq17_marts)

# ---- health score --------------------------------------------------------------------------------------


def _dq18(t):
    m, n = quality.measured, F.col("n")
    orders = t.fct_orders.agg(
        F.count("*").alias("n"),
        *[(F.count_if(F.col(c).isNull()) * 100.0 / F.count("*")).alias(f"null_{c}") for c in ("customer_key", "product_key", "revenue")],
        (F.count("*") - F.count_distinct("order_id")).alias("duplicates"),
    )
    lost = integrity.orphans(t.fct_orders, t.dim_customers, "customer_id")
    stale = t.fct_dau.agg(F.datediff(F.lit(EVENTS_AS_OF).cast("date"), F.max("event_date")).alias("n"))
    checks = [
        m("row_count", "fct_orders", orders, n, 23500),
        m("duplicates", "fct_orders.order_id", orders, F.col("duplicates")),
        *[m("null_rate", f"fct_orders.{c}", orders, F.col(f"null_{c}")) for c in ("customer_key", "product_key", "revenue")],
        m("row_count", "dim_customers", t.dim_customers.agg(F.count("*").alias("n")), n, 1400),
        m("row_count", "dim_products", t.dim_products.agg(F.count("*").alias("n")), n, 5000),
        m("orphans", "fct_orders", lost, F.col("orphans")),
        m("stale", "fct_daily_active_users", stale, n),
    ]
    return quality.health_score(quality.union_all(checks))


query(
    "dq18_health_score",
    """, p AS (SELECT CASE WHEN count(*) < 11750 THEN 30 ELSE 0 END + CASE WHEN count(*) > count(DISTINCT order_id) THEN 30 ELSE 0 END AS pts FROM fct_orders
      UNION ALL SELECT CASE WHEN count(*) < 700 THEN 30 ELSE 0 END FROM dim_customers
      UNION ALL SELECT CASE WHEN count(*) < 2500 THEN 30 ELSE 0 END FROM dim_products
      UNION ALL SELECT CASE WHEN count(*) > 0 THEN 15 ELSE 0 END FROM fct_orders WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)
      UNION ALL SELECT CASE WHEN DATE '2024-01-31' - max(event_date) > 2 THEN 10 ELSE 0 END FROM fct_dau)
      SELECT score, CASE WHEN score >= 90 THEN 'HEALTHY' WHEN score >= 70 THEN 'WARNING' ELSE 'CRITICAL' END AS band
      FROM (SELECT CAST(greatest(0, 100 - sum(pts)) AS BIGINT) AS score FROM p)""",
)(_dq18)

# ---- expectations ----------------------------------------------------------------------------------------


def _expectation_sql(suite: dict, table: str) -> str:
    parts = []
    for place, rule in enumerate(suite["expectations"]):
        kind, args = rule["expectation_type"], rule["kwargs"]
        col, low, high = args.get("column"), args.get("min_value"), args.get("max_value")
        limits = [f"observed >= {low}"] * (low is not None) + [f"observed <= {high}"] * (high is not None)
        zero = ["observed = 0"]
        outside = " OR ".join([f"{col} < {low}"] * (low is not None) + [f"{col} > {high}"] * (high is not None))
        listed = ", ".join(repr(v) for v in args.get("value_set", []))
        value, tests = {
            "expect_table_row_count_to_be_between": ("count(*)", limits),
            "expect_column_values_to_not_be_null": (f"count(*) FILTER ({col} IS NULL)", zero),
            "expect_column_values_to_be_in_set": (f"count(*) FILTER ({col} NOT IN ({listed}))", zero),
            "expect_column_values_to_be_between": (f"count(*) FILTER ({outside})", zero),
            "expect_column_values_to_be_unique": (f"count({col}) - count(DISTINCT {col})", zero),
            "expect_column_proportion_of_unique_values_to_be_between": (f"count(DISTINCT {col}) / count({col})", limits),
        }[kind]
        name = "NULL" if col is None else f"'{col}'"
        parts.append(
            f"""SELECT '{suite["expectation_suite_name"]}' AS suite, CAST({place} AS INT) AS position, '{kind}' AS expectation_type,
              CAST({name} AS VARCHAR) AS "column", CAST(observed AS DOUBLE) AS observed, {' AND '.join(tests)} AS success
              FROM (SELECT {value} AS observed FROM {table})"""
        )
    return "\nUNION ALL ".join(parts)


SUITES = {
    "orders": (suites.FCT_ORDERS, "fct_orders"),
    "customers": (suites.DIM_CUSTOMERS, "dim_customers"),
    "procurement": (suites.FCT_PROCUREMENT, "fct_procurement"),
    "dau": (suites.FCT_DAU, "fct_dau"),
    "events": (suites.STG_EVENTS, "stg_events"),
    "staging_orders": (suites.STG_ORDERS, "stg_orders"),
}
# Small dimensions that are written before the fact is joined to them.
DIMENSIONS = {"fct_orders": ("dim_products",), "fct_procurement": ("dim_vendors",)}
for _name, (_suite, _table) in SUITES.items():
    query(f"dq19_expectations_{_name}", _expectation_sql(_suite, _table))(
        lambda t, suite=_suite, table=_table: quality.validate(getattr(t.with_dimensions(*DIMENSIONS.get(table, ())), table), suite)
    )

CHECKPOINT = ["orders", "customers", "procurement", "staging_orders"]
query(
    "dq20_checkpoint",
    "SELECT suite, count(*) AS evaluated, count(*) FILTER (NOT success) AS failed, bool_and(success) AS success FROM ("
    + " UNION ALL ".join(_expectation_sql(*SUITES[n]) for n in CHECKPOINT)
    + ") GROUP BY suite",
)(lambda t: quality.run_checkpoint([(getattr(t, SUITES[n][1]), SUITES[n][0]) for n in CHECKPOINT]))
query(
    "dq21_non_empty",
    "SELECT 'saas_users' AS table_name, count(*) > 0 AS ok FROM stg_users UNION ALL SELECT 'saas_events', count(*) > 0 FROM stg_events",
)(lambda t: quality.assert_non_empty({"saas_users": t.stg_users, "saas_events": t.stg_events}))

# ---- profiles --------------------------------------------------------------------------------------------


def _profile_sql(label: str, table: str, columns: dict[str, str]) -> str:
    parts = []
    for c, dtype in columns.items():
        number = _is_number(dtype)
        stats = [f"{f}(CAST({c} AS DOUBLE))" if number else "CAST(NULL AS DOUBLE)" for f in ("min", "max", "avg", "stddev")]
        distinct = f"(SELECT count(*) FROM (SELECT DISTINCT {c} FROM {table}))" if dtype == "string" else "CAST(NULL AS BIGINT)"
        top = (
            f"""(SELECT string_agg(coalesce({c}, 'NULL'), ' | ' ORDER BY n DESC, {c} NULLS FIRST) FROM (SELECT {c}, count(*) AS n
              FROM {table} GROUP BY 1 ORDER BY n DESC, {c} NULLS FIRST LIMIT 5))"""
            if dtype == "string"
            else "CAST(NULL AS VARCHAR)"
        )
        parts.append(
            f"""SELECT '{label}' AS source, '{c}' AS column_name, '{dtype}' AS dtype, count(*) AS row_count,
              count(*) FILTER ({c} IS NULL) AS null_count, round(count(*) FILTER ({c} IS NULL) / count(*), 4) AS null_rate,
              {stats[0]} AS min_val, {stats[1]} AS max_val, {stats[2]} AS mean_val, {stats[3]} AS stddev_val,
              {distinct} AS distinct_count, {top} AS top5_values FROM {table}"""
        )
    return "\nUNION ALL ".join(parts)


def _shape(df):
    """Rounded statistics, so that the order of additions does not matter."""
    return df.withColumns({c: F.round(c, 6) for c in ("mean_val", "stddev_val")})


query(
    "prf1_profile",
    "SELECT * REPLACE (round(mean_val, 6) AS mean_val, round(stddev_val, 6) AS stddev_val) FROM ("
    + _profile_sql("dim_customers", "dim_customers", CUSTOMERS)
    + ")",
)(lambda t: _shape(profiling.profile(t.dim_customers, "dim_customers")))


FREQUENT = {
    "customer": ["c_name", "c_mktsegment", "c_nationkey"], "supplier": ["s_name", "s_nationkey"], "part": ["p_name", "p_brand", "p_type", "p_size"],
    "orders": ["o_custkey", "o_orderstatus", "o_orderpriority"], "lineitem": ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"],
    "events": ["user_id", "event_type"], "documents": ["lang", "source", "text"], "conversations": ["role", "text"],
}


def _frequent(t):
    """The most frequent values of text, key and code columns of the given tables."""
    parts = [frequent.frequent_values(t.table(n), columns).withColumn("table_name", F.lit(n)) for n, columns in FREQUENT.items()]
    return quality.union_all(parts).select("table_name", "column_name", "value", "rows")


query(
    "prf1_frequent_values",
    " UNION ALL ".join(
        f"""(SELECT '{table}' AS table_name, '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS rows FROM {table}
          GROUP BY {c} ORDER BY 4 DESC, 3 NULLS FIRST LIMIT 5)"""
        for table, columns in FREQUENT.items()
        for c in columns
    ),
)(_frequent)


def _stats_sql() -> str:
    parts = []
    for c, dtype in ORDERS.items():
        number = _is_number(dtype)
        p = [f"round(quantile_disc(CAST({c} AS DOUBLE), {q}), 2)" if number else "CAST(NULL AS DOUBLE)" for q in (0.05, 0.95)]
        top = (
            "CAST(NULL AS VARCHAR)"
            if dtype != "string"
            else f"""CASE WHEN count(DISTINCT {c}) <= 20 THEN (SELECT string_agg(coalesce({c}, 'NULL'), ' | ' ORDER BY n DESC, {c} NULLS FIRST)
              FROM (SELECT {c}, count(*) AS n FROM fct_orders GROUP BY 1 ORDER BY n DESC, {c} NULLS FIRST LIMIT 5)) END"""
        )
        parts.append(
            f"""SELECT '{c}' AS column_name, '{dtype}' AS dtype, count(*) AS row_count, round(count(*) FILTER ({c} IS NULL OR
              CAST({c} AS VARCHAR) = '') * CAST(100.0 AS DOUBLE) / count(*), 1) AS null_pct, count(DISTINCT {c}) AS cardinality,
              {p[0]} AS p5, {p[1]} AS p95, {top} AS top_values FROM fct_orders"""
        )
    return "\nUNION ALL ".join(parts)


query("prf2_profile_stats")(lambda t: profiling.profile_stats(t.fct_orders))
query("prf2_profile_stats_exact", _stats_sql())(
    lambda t: profiling.profile_stats(t.fct_orders, exact=True, accuracy=1_000_000)
)


def _close(approximate: str, exact: str, share: float):
    """Whether a sketched figure lies within a share of the exact one."""
    return F.coalesce(F.abs(F.col(approximate) - F.col(exact)) <= F.abs(exact) * share, F.col(exact).isNull())


def _sketch_error(t):
    """Exact figures, and whether the sketches come close to them."""
    df = t.fct_orders
    sketch = profiling.profile_stats(df).select("column_name", *[F.col(c).alias(f"s_{c}") for c in ("cardinality", "p5", "p95")])
    exact = profiling.profile_stats(df, exact=True, accuracy=1_000_000)
    flags = [_close(f"s_{c}", c, share).alias(f"{c}_close") for c, share in [("cardinality", 0.1), ("p5", 0.05), ("p95", 0.05)]]
    return exact.join(sketch, "column_name").select("column_name", "cardinality", "p5", "p95", *flags)


query(
    "prf2_sketch_error",
    "SELECT column_name, cardinality, p5, p95, true AS cardinality_close, true AS p5_close, true AS p95_close FROM (" + _stats_sql() + ")",
)(_sketch_error)


def _agg26(t):
    """Sketched figures against exact ones."""
    row = t.fct_orders.agg(
        F.approx_count_distinct("customer_id").alias("s_customers"),
        F.percentile_approx("amount", 0.5, 10_000).cast("double").alias("s_median"),
        F.count_distinct("customer_id").alias("customers"),
        F.percentile(F.col("amount").cast("double"), 0.5).alias("median_amount"),
    )
    flags = [_close("s_customers", "customers", 0.1).alias("customers_close"), _close("s_median", "median_amount", 0.02).alias("median_close")]
    return row.select("customers", F.round("median_amount", 3).alias("median_amount"), *flags)


query(
    "agg26_approximate_stats",
    """SELECT count(DISTINCT customer_id) AS customers, round(quantile_cont(CAST(amount AS DOUBLE), 0.5), 3) AS median_amount,
      true AS customers_close, true AS median_close FROM fct_orders""",
)(_agg26)


def _prf3(t):
    names = ["customer", "supplier", "region"]
    sources = {n: f"{t.dir}/{n}.parquet" for n in names} | {"absent": f"{t.dir}/absent.parquet"}
    report = profiling.profile_sources(t.spark, sources)
    return report.select(
        "source", "column_name", "row_count", "null_count", "distinct_count", F.col("error").isNotNull().alias("failed")
    )


def _prf3_sql() -> str:
    parts = ["SELECT 'absent' AS source, '_error_' AS column_name, CAST(NULL AS BIGINT) AS row_count, CAST(NULL AS BIGINT) AS null_count, CAST(NULL AS BIGINT) AS distinct_count, true AS failed"]
    for table in ("customer", "supplier", "region"):
        for field in SCHEMAS[table].split(", "):
            c, dtype = field.split(" ")
            distinct = f"count(DISTINCT {c})" if dtype == "string" else "NULL"
            parts.append(f"SELECT '{table}', '{c}', count(*), count(*) - count({c}), {distinct}, false FROM {table}")
    return " UNION ALL ".join(parts)


query("prf3_profile_sources", _prf3_sql())(_prf3)

# ---- contracts -------------------------------------------------------------------------------------------

REQUIRED = ("order_id", "customer_key", "amount")


def _contract(t):
    return contracts.generate_contract(t.fct_orders, required=set(REQUIRED))


CONTRACT_ROW = "SELECT 'expect_{0}' AS expectation_type, {1} AS \"column\", CAST({2} AS DOUBLE) AS min_value, CAST({3} AS DOUBLE) AS max_value FROM {4}"


def _contract_sql(table: str = "fct_orders", columns: dict[str, str] = ORDERS, required: tuple[str, ...] = REQUIRED) -> str:
    rows = [("table_row_count_to_be_between", "NULL", "floor(count(*) * 0.9)", "floor(count(*) * 1.1) + 100")]
    rows += [("column_to_exist", f"'{c}'", "NULL", "NULL") for c in columns]
    rows += [("column_values_to_not_be_null", f"'{c}'", "NULL", "NULL") for c in required]
    rows += [("column_values_to_be_between", f"'{c}'", f"min({c})", f"max({c})") for c in required if _is_number(columns[c])]
    rows += [("column_values_to_be_unique", f"'{c}'", "NULL", "NULL") for c in columns if c.endswith(("_id", "_key"))]
    one = f"(SELECT count(*) FROM {table})"
    return " UNION ALL ".join(CONTRACT_ROW.format(*r, table if any("(" in x for x in r[2:]) else one) for r in rows)


query("con1_generate_contract", _contract_sql())(_contract)


def _stat_contract_sql() -> str:
    blank = lambda c: f"nullif({c}, '')" if ORDERS[c] == "string" else c
    rows = [("table_row_count_to_be_between", "NULL", "count(*) * 0.5", "count(*) * 2", "true")]
    rows += [("column_values_to_not_be_null", f"'{c}'", "NULL", "NULL", f"count(*) = count({blank(c)})") for c in ORDERS]
    rows += [("column_values_to_be_unique", f"'{c}'", "NULL", "NULL", "true") for c in ORDERS if c.endswith(("_id", "_key"))]
    for c in (c for c, dtype in ORDERS.items() if _is_number(dtype)):
        p = [f"round(quantile_disc(CAST({c} AS DOUBLE), {q}), 2)" for q in (0.05, 0.95)]
        rows.append(("column_values_to_be_between", f"'{c}'", p[0], f"round(CAST({p[1]} AS DECIMAL(20, 2)) * 1.5, 2)", "true"))
    parts = [
        f"""SELECT 'expect_{a}' AS expectation_type, {b} AS "column", CAST({c} AS DOUBLE) AS min_value, CAST({d} AS DOUBLE) AS max_value,
          CAST(NULL AS VARCHAR) AS value_set FROM fct_orders HAVING {e}"""
        for a, b, c, d, e in rows
    ]
    parts += [
        f"""SELECT 'expect_column_values_to_be_in_set', '{c}', NULL, NULL, string_agg(DISTINCT {c}, '|' ORDER BY {c}) FROM fct_orders
          WHERE {c} IS NOT NULL HAVING count(DISTINCT {c}) BETWEEN 1 AND 19"""
        for c in (c for c, dtype in ORDERS.items() if dtype == "string")
    ]
    return " UNION ALL ".join(parts)


query("con2_generate_stat_contract", _stat_contract_sql())(lambda t: contracts.generate_stat_contract(t.fct_orders, accuracy=1_000_000))


def _con3(t):
    good = contracts.contract_json(_contract(t), "gold_fct_orders")
    bad = t.test_results.select(F.concat(F.lit("results_"), F.col("doc_id").cast("string")).alias("name"), "json")
    return contracts.validate_contract(good.unionByName(bad))


query(
    "con3_validate_contract",
    f"""SELECT 'gold_fct_orders' AS name, (SELECT CAST(count(*) AS INT) FROM ({_contract_sql()})) AS items, CAST(0 AS INT) AS broken, true AS valid
      UNION ALL SELECT 'results_' || event_id, NULL, NULL, false FROM events""",
)(_con3)


def _con4(t):
    path = scratch_path(t.spark, "suites")
    contracts.contract_json(_contract(t), "gold_fct_orders").select("json").write.text(f"{path}/gold_fct_orders")
    customers = contracts.generate_contract(t.dim_customers, required={"customer_key"})
    contracts.contract_json(customers, "gold_dim_customers").select("json").write.text(f"{path}/gold_dim_customers")
    return contracts.list_suites(t.spark, path)


query(
    "con4_list_suites",
    f"""SELECT 'gold_fct_orders' AS suite, (SELECT CAST(count(*) AS INT) FROM ({_contract_sql()})) AS expectations
      UNION ALL SELECT 'gold_dim_customers', (SELECT CAST(count(*) AS INT) FROM ({_contract_sql("dim_customers", CUSTOMERS, ("customer_key",))}))""",
)(_con4)

# ---- governance ------------------------------------------------------------------------------------------


def _catalog(t):
    """Columns of the gold tables that the log can mention."""
    tables = t.gold_tables | {"fct_mrr": t.fct_mrr, "fct_daily_active_users": t.fct_dau}
    return governance.schema_rows(tables, "gold").select("schema_name", "table_name", "column_name")


def _usage(t, **options):
    return governance.column_usage(t.query_log, _catalog(t), QUERY_LOG_AS_OF, **options)


GOLD_COLUMNS = {
    "fct_orders": "order_id customer_key product_key customer_id product_id amount quantity revenue status order_date order_date_day order_month order_year updated_at customer_segment customer_country product_category product_price_tier product_name",
    "fct_procurement": "po_id vendor_key vendor_id amount fulfilled_amount line_items lead_time_days status currency requested_by description po_date po_date_day delivery_date updated_at vendor_name vendor_country vendor_category payment_terms",
    "fct_reviews": "review_id user_id product_key product_id rating summary review_text created_at product_name product_category price_tier",
    "dim_customers": "customer_key customer_id first_name last_name full_name email phone segment country city updated_at days_since_signup version valid_from valid_to is_current",
    "dim_products": "product_key product_id name category price price_tier current_stock_quantity sku is_in_stock created_at updated_at version",
    "dim_vendors": "vendor_key vendor_id name contact_name email phone country city category payment_terms is_active created_at updated_at version",
    "fct_mrr": "plan billing_cycle total_subscribers total_mrr avg_mrr active_subscribers churned_subscribers",
    "fct_daily_active_users": "event_date dau total_events logins signups upgrades payment_failures",
}
CATALOG_VALUES = ", ".join(f"('{t}', '{c}')" for t, cols in GOLD_COLUMNS.items() for c in cols.split())
USAGE = f""", cat(table_name, column_name) AS (VALUES {CATALOG_VALUES}),
  asked AS (SELECT lower(query) AS q, event_time FROM query_log WHERE event_time >= TIMESTAMP '2024-01-30 12:00:00' AND
    type = 'QueryFinish' AND query_kind = 'Select' AND contains(lower(query), 'gold.')),
  usage AS (SELECT 'gold' AS schema_name, table_name, column_name, count(q) AS query_count_24h, max(event_time) AS last_queried_at,
    DATE '2024-01-31' AS captured_at FROM cat LEFT JOIN asked ON {{match}} GROUP BY 1, 2, 3)"""
SUBSTRING = USAGE.format(match="contains(q, lower(column_name))")
WORDS = USAGE.format(match="list_contains(string_split_regex(q, '[^a-z0-9_]+'), lower(column_name))")

query("gov1_column_usage", SUBSTRING + " SELECT * FROM usage")(_usage)
query("jn13_containment_join", SUBSTRING + " SELECT * FROM usage")(_usage)
query("gov1_column_usage_whole_words", WORDS + " SELECT * FROM usage")(lambda t: _usage(t, whole_word=True))
query(
    "gov2_hot_cold",
    SUBSTRING + """ SELECT count(*) AS columns, count(*) FILTER (query_count_24h >= 5) AS hot, count(*) FILTER (query_count_24h = 0) AS cold
      FROM usage""",
)(lambda t: governance.hot_cold(_usage(t)))
HOT = SUBSTRING + " SELECT DISTINCT schema_name, table_name FROM usage WHERE query_count_24h >= 5"
query("gov2_hot_tables", HOT)(lambda t: governance.hot_tables(_usage(t)))
query("agg27_distinct_hot_tables", HOT)(lambda t: governance.hot_tables(_usage(t)))
query(
    "gov3_deprecations",
    SUBSTRING
    + """ SELECT schema_name, table_name, count(*) AS cold_columns, string_agg(column_name, ', ' ORDER BY column_name) AS columns
      FROM usage WHERE query_count_24h = 0 GROUP BY 1, 2""",
)(lambda t: governance.deprecations(_usage(t)))
query(
    "gov4_top_columns",
    SUBSTRING
    + """ SELECT schema_name, table_name, column_name, query_count_24h FROM usage
      ORDER BY query_count_24h DESC, schema_name, table_name, column_name LIMIT 20""",
)(lambda t: governance.top_columns(_usage(t)))
query(
    "gov5_flag_unsafe_sql",
    r"""SELECT query_id, regexp_matches(regexp_replace(lower(query), '\s+', ' ', 'g'),
      '\b(drop|delete|insert|update|truncate|alter|create|replace|rename|attach|detach|optimize|system reload|system drop)\b') AS is_unsafe
      FROM query_log""",
)(lambda t: governance.flag_unsafe_sql(t.query_log))
query(
    "gov6_table_refs",
    r"""SELECT DISTINCT query_id, unnest(regexp_extract_all(query, '\b(?:gold|staging)\.((?:fct_|dim_|stg_|mart_)\w+)\b', 1)) AS table_name
      FROM query_log""",
)(lambda t: governance.table_refs(t.query_log))

# ---- schemas ---------------------------------------------------------------------------------------------


def _attributes(t, day: str):
    """The schema that the events of a day use: event types as tables, the attributes named in ``props`` as columns."""
    events = t.table("events").filter(F.to_date("ts") == day)
    named = F.concat(F.lit("k_"), F.get_json_object("props", "$.k"))
    return events.select(F.col("event_type").alias("table_name"), named.alias("column_name")).distinct()


NOW, BEFORE = "2024-01-30", "2024-01-29"
ATTRIBUTES = f"""WITH attributes AS (SELECT DISTINCT CAST(ts AS DATE) AS day, event_type AS table_name,
    'k_' || regexp_extract(props, '"k": *([0-9]+)', 1) AS column_name FROM events),
  now AS (SELECT table_name, column_name FROM attributes WHERE day = DATE '{NOW}'),
  before AS (SELECT table_name, column_name FROM attributes WHERE day = DATE '{BEFORE}'),
  added AS (SELECT * FROM now EXCEPT SELECT * FROM before), removed AS (SELECT * FROM before EXCEPT SELECT * FROM now)"""
query(
    "drf1_schema_evolution",
    ATTRIBUTES + " SELECT *, 'added' AS drift_type FROM added UNION ALL SELECT *, 'removed' FROM removed",
)(lambda t: governance.schema_evolution(_attributes(t, NOW), _attributes(t, BEFORE)))
query("set1_set_difference", ATTRIBUTES + " SELECT * FROM added")(lambda t: _attributes(t, NOW).exceptAll(_attributes(t, BEFORE)))
query(
    "drf2_schema_drift",
    ATTRIBUTES
    + """ SELECT table_name, coalesce(string_agg(a, ', ' ORDER BY a), '') AS added, coalesce(string_agg(r, ', ' ORDER BY r), '') AS removed
      FROM (SELECT table_name, column_name AS a, NULL AS r FROM added UNION ALL SELECT table_name, NULL, column_name FROM removed) GROUP BY 1""",
)(lambda t: governance.schema_drift(_attributes(t, BEFORE), _attributes(t, NOW)))


# ---- schemas of documents --------------------------------------------------------------------------------


def _documents(t):
    """Documents of two sources by period: what events carry, by day, and orders as documents whose form changed in 1996."""
    events = t.table("events").select(F.concat(F.lit("events/"), "event_type").alias("source"), F.to_date("ts").cast("string").alias("period"), F.col("props").alias("document"))
    new = F.year("o_orderdate") >= 1996
    who = F.struct(F.col("o_custkey").alias("id"), F.when(new, F.struct(F.col("o_orderpriority").alias("level"))).alias("care"))
    document = F.struct(
        F.when(~new, F.col("o_orderkey")).alias("id"), F.when(new, F.struct(F.col("o_orderkey").cast("string").alias("no"))).alias("order"),
        F.when(new, F.col("o_custkey").cast("string")).otherwise(F.lit("x")).alias("ref"), F.when(new, F.array(F.struct(F.year("o_orderdate").alias("y")))).alias("parts"),
        F.when(~new, F.col("o_orderstatus")).alias("status"), who.alias("customer"), F.round("o_totalprice", 2).cast("decimal(15,2)").alias("total"),
    )
    numbers = F.to_json(F.struct(F.when(new, F.col("o_custkey").cast("string")).alias("key_text"), F.when(~new, F.col("o_custkey")).alias("key")))
    text = F.regexp_replace(numbers, "key_text", "key")  # the same key, a number before and a string after
    orders = t.table("orders")
    period = F.when(new, "since 1996").otherwise("before 1996").alias("period")
    return events.unionByName(orders.select(F.lit("orders").alias("source"), period, F.to_json(document).alias("document"))).unionByName(
        orders.select(F.lit("order keys").alias("source"), period, text.alias("document"))
    )


def _document_paths(t):
    return schema_census.schema_paths(schema_census.schema_census(_documents(t), ["source", "period"], "document"), ["source", "period"])


DOCUMENTS = """WITH docs AS (SELECT 'events/' || event_type AS source, CAST(CAST(ts AS DATE) AS VARCHAR) AS period, CAST(props AS JSON) AS document FROM events
  UNION ALL SELECT 'orders', 'since 1996', json_object('order', json_object('no', CAST(o_orderkey AS VARCHAR)), 'ref', CAST(o_custkey AS VARCHAR),
    'parts', json_array(json_object('y', year(o_orderdate))), 'customer', json_object('id', o_custkey, 'care', json_object('level', o_orderpriority)), 'total', 0.5)
    FROM orders WHERE year(o_orderdate) >= 1996
  UNION ALL SELECT 'orders', 'before 1996', json_object('id', o_orderkey, 'ref', 'x', 'status', o_orderstatus, 'customer', json_object('id', o_custkey), 'total', 0.5)
    FROM orders WHERE year(o_orderdate) < 1996
  UNION ALL SELECT 'order keys', CASE WHEN year(o_orderdate) >= 1996 THEN 'since 1996' ELSE 'before 1996' END,
    CASE WHEN year(o_orderdate) >= 1996 THEN json_object('key', CAST(o_custkey AS VARCHAR)) ELSE json_object('key', o_custkey) END FROM orders),
  seen AS (SELECT DISTINCT source, period, regexp_replace(j.fullkey, '\\[[0-9]+\\]', '[]', 'g') AS path,
    CASE j.type WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'VARCHAR' THEN 'STRING' WHEN 'DOUBLE' THEN 'DECIMAL' ELSE j.type END AS type FROM docs, json_tree(document) j),
  paths AS (SELECT source, period, path, CASE WHEN count(*) = 1 THEN max(type) ELSE 'VARIANT' END AS type FROM seen GROUP BY 1, 2, 3)"""
DRIFTED = """ SELECT coalesce(o.source, n.source) AS source, coalesce(o.path, n.path) AS path,
  CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' ELSE 'retyped' END AS change, o.type AS old_type, n.type AS new_type
  FROM (SELECT * FROM paths WHERE {before}) o FULL JOIN (SELECT * FROM paths WHERE {after}) n ON o.source = n.source AND o.path = n.path
  WHERE o.type IS DISTINCT FROM n.type"""
query("drf1_document_paths", DOCUMENTS + " SELECT * FROM paths")(_document_paths)


def _document_changes(t):
    paths = _document_paths(t)
    before, after = (paths.filter(F.col("period").isin(*periods)) for periods in ((BEFORE, "before 1996"), (NOW, "since 1996")))
    return schema_census.schema_changes(before, after, ["source"])


query("drf1_document_changes", DOCUMENTS + DRIFTED.format(before=f"period IN ('{BEFORE}', 'before 1996')", after=f"period IN ('{NOW}', 'since 1996')"))(_document_changes)
#: What an older contract declares for three of the given tables.
DECLARED = {
    "customer": "c_custkey bigint, c_name string, c_phone string, c_nationkey bigint, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey string, o_orderstatus string, o_totalprice double, o_clerk string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _declared_columns(t):
    columns = lambda tables: governance.schema_rows(tables, "raw").select("table_name", F.col("column_name").alias("path"), F.col("data_type").alias("type"))
    declared = columns({n: t.spark.createDataFrame([], ddl) for n, ddl in DECLARED.items()})
    return schema_census.schema_changes(declared, columns({n: t.spark.read.parquet(f"{t.dir}/{n}.parquet") for n in DECLARED}), ["table_name"])


query(
    "drf2_declared_columns",
    "WITH declared AS (SELECT * FROM (VALUES "
    + ", ".join(f"('{n}', '{c.split(' ')[0]}', '{c.split(' ')[1]}')" for n, ddl in DECLARED.items() for c in ddl.split(", "))
    + ") AS v(table_name, path, type)), actual AS ("
    + " UNION ALL ".join(f"SELECT '{n}' AS table_name, column_name AS path, column_type AS kind FROM (DESCRIBE {n})" for n in DECLARED)
    + """), typed AS (SELECT table_name, path, CASE kind WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int'
      ELSE lower(kind) END AS type FROM actual)
      SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(o.path, n.path) AS path, CASE WHEN o.path IS NULL THEN 'added'
        WHEN n.path IS NULL THEN 'removed' ELSE 'retyped' END AS change, o.type AS old_type, n.type AS new_type
      FROM declared o FULL JOIN typed n ON o.table_name = n.table_name AND o.path = n.path WHERE o.type IS DISTINCT FROM n.type""",
)(_declared_columns)
CATALOGUED = ["region", "nation", "customer", "orders", "lineitem", "events"]
query(
    "drf3_catalog",
    " UNION ALL ".join(
        f"SELECT 'raw' AS schema_name, '{n}' AS table_name, '{c.split(' ')[0]}' AS column_name, '{c.split(' ')[1]}' AS data_type, count(*) AS row_count FROM {n}"
        for n in CATALOGUED
        for c in SCHEMAS[n].split(", ")
    ),
)(lambda t: governance.catalog({n: t.table(n) for n in CATALOGUED}, "raw"))
query(
    "mta1_log_run",
    """SELECT DATE '2001-08-01' AS run_date, 'run_1' AS run_id, 'daily' AS dag_id, (SELECT count(*) FROM fct_orders) AS fct_orders_rows,
      (SELECT count(*) FROM dim_customers) AS dim_customers_rows, CAST((SELECT sum(n) FROM ("""
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {n}" for n in GOLD)
    + ")) AS BIGINT) AS gold_tables_rows",
)(lambda t: governance.log_run(t.gold_tables, ORDERS_AS_OF, "run_1", "daily"))


def _mta1_stored(t):
    """Two daily runs, the second delivered twice, and what the history holds of them."""
    gold = t.with_dimensions(*t.gold_tables).gold_tables
    path = scratch_path(t.spark, "runs")
    for day, run in (("2001-07-31", "run_0"), ("2001-08-01", "run_1"), ("2001-08-01", "run_1")):
        landed = governance.log_run(gold, day, run, "daily")
        history.append_run(landed, path, day)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in landed.schema if f.name != history.RUN)
    return history.latest_runs(history.read_history(t.spark, path, columns), 2)


query(
    "mta1_stored_runs",
    """SELECT run_date, run_id, 'daily' AS dag_id, (SELECT count(*) FROM fct_orders) AS fct_orders_rows,
      (SELECT count(*) FROM dim_customers) AS dim_customers_rows, CAST((SELECT sum(n) FROM ("""
    + " UNION ALL ".join(f"SELECT count(*) AS n FROM {n}" for n in GOLD)
    + ")) AS BIGINT) AS gold_tables_rows FROM (VALUES (DATE '2001-07-31', 'run_0'), (DATE '2001-08-01', 'run_1')) v(run_date, run_id)",
)(_mta1_stored)
