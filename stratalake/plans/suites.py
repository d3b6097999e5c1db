"""Declared expectation suites and schema tests of the lake's tables. All entries are fixed values."""

from __future__ import annotations

from collections.abc import Sequence


def not_null(*columns: str) -> list[dict]:
    return [{"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": c}} for c in columns]


def unique(*columns: str) -> list[dict]:
    return [{"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": c}} for c in columns]


def exists(*columns: str) -> list[dict]:
    return [{"expectation_type": "expect_column_to_exist", "kwargs": {"column": c}} for c in columns]


def in_set(column: str, values: Sequence) -> list[dict]:
    return [{"expectation_type": "expect_column_values_to_be_in_set", "kwargs": {"column": column, "value_set": list(values)}}]


def _bounded(kind: str, low, high, column: str | None = None) -> list[dict]:
    bounds = {"column": column, "min_value": low, "max_value": high}
    return [{"expectation_type": kind, "kwargs": {k: v for k, v in bounds.items() if v is not None}}]


def between(column: str, low=None, high=None) -> list[dict]:
    return _bounded("expect_column_values_to_be_between", low, high, column)


def row_count(low=None, high=None) -> list[dict]:
    return _bounded("expect_table_row_count_to_be_between", low, high)


def unique_share(column: str, low=None, high=None) -> list[dict]:
    return _bounded("expect_column_proportion_of_unique_values_to_be_between", low, high, column)


def suite(name: str, *rules: list[dict]) -> dict:
    return {"expectation_suite_name": name, "expectations": [r for group in rules for r in group]}


PO_STATUSES = ["OPEN", "APPROVED", "RECEIVED", "CLOSED", "CANCELLED"]
ORDER_STATUSES = ["pending", "completed", "cancelled"]
SEGMENTS = ["B2B", "B2C", "VIP"]
TIERS = ["Budget", "Mid-range", "Premium", "Luxury"]
TERMS = ["NET30", "NET60", "NET90", "IMMEDIATE"]
CURRENCIES = ["USD", "EUR", "GBP", "INR"]
PLANS = ["starter", "growth", "enterprise", "free"]
EVENT_TYPES = [
    "login", "signup", "upgrade", "downgrade", "payment_failed", "page_view", "feature_use", "feature_used", "logout",
    "click", "export", "invite_sent",
]

FCT_ORDERS = suite(
    "gold_fct_orders",
    not_null("order_id", "customer_key", "product_key"),
    unique("order_id"),
    between("amount", 269.99, 4743.24),
    between("quantity", 1.0, 10.0),
    in_set("status", ORDER_STATUSES),
    row_count(11755.5, 47022),
)
DIM_CUSTOMERS = suite(
    "gold_dim_customers",
    not_null("customer_key", "customer_id", "first_name", "last_name", "full_name", "email", "phone"),
    in_set("segment", SEGMENTS),
    between("customer_id", 71.9, 69621.75),
    between("days_since_signup", 32.0, 997.65),
    row_count(709.5, 2838),
    unique("customer_key", "customer_id"),
)
FCT_PROCUREMENT = suite(
    "gold_fct_procurement",
    not_null("po_id", "vendor_key", "vendor_id"),
    between("amount", 10619.19, 359260.44),
    between("fulfilled_amount", 0.0, 336539.8),
    between("line_items", 1.95, 28.5),
    between("lead_time_days", 11.95, 130.5),
    in_set("status", PO_STATUSES),
    in_set("currency", CURRENCIES),
    unique("po_id"),
    row_count(150, 600),
)
FCT_DAU = suite(
    "gold_fct_daily_active_users",
    not_null("event_date", "dau", "total_events", "logins", "signups", "upgrades", "payment_failures"),
    between("dau", 40.65, 1915.55),
    between("total_events", 42.65, 2049.52),
    between("logins", 3.65, 323.55),
    between("signups", 4.0, 109.5),
    between("upgrades", 3.0, 69.0),
    between("payment_failures", 0.0, 16.5),
    row_count(67, 268),
)
STG_EVENTS = suite(
    "staging_stg_events",
    not_null("event_id", "user_id", "event_type", "page", "occurred_at", "event_date"),
    in_set("event_type", ["page_view", "click", "login", "feature_used", "logout"]),
    in_set("page", ["/billing", "/reports", "/settings", "/dashboard", "/pricing"]),
    unique("event_id"),
    row_count(30519, 122076),
)
STG_ORDERS = suite(
    "staging_stg_orders",
    row_count(100, 10000000),
    not_null("order_id", "customer_id", "product_id", "amount"),
    in_set("status", ORDER_STATUSES),
    between("amount", 0.01),
    unique_share("order_id", 0.99),
)

KEY = ["unique", "not_null"]
REQUIRED = ["not_null"]


def accepted(values: Sequence) -> dict:
    return {"accepted_values": list(values)}


def refers(table: str, column: str) -> dict:
    return {"relationships": (table, column)}


SCHEMA_TESTS: dict[str, dict[str, list]] = {
    "stg_customers": {
        "customer_id": KEY,
        "email": KEY,
        "segment": [*REQUIRED, accepted(SEGMENTS)],
        "country": REQUIRED,
        "created_at": REQUIRED,
    },
    "stg_orders": {
        "order_id": KEY,
        "customer_id": REQUIRED,
        "product_id": REQUIRED,
        "amount": REQUIRED,
        "status": [*REQUIRED, accepted(ORDER_STATUSES)],
        "order_date": REQUIRED,
    },
    "stg_products": {
        "product_id": KEY,
        "sku": KEY,
        "price": REQUIRED,
        "price_tier": [*REQUIRED, accepted(TIERS)],
        "category": REQUIRED,
    },
    "stg_vendors": {
        "vendor_id": KEY,
        "name": REQUIRED,
        "category": REQUIRED,
        "payment_terms": [*REQUIRED, accepted(TERMS)],
    },
    "stg_purchase_orders": {
        "po_id": KEY,
        "vendor_id": [*REQUIRED, refers("stg_vendors", "vendor_id")],
        "amount": REQUIRED,
        "status": [*REQUIRED, accepted(PO_STATUSES)],
        "currency": [*REQUIRED, accepted(CURRENCIES)],
    },
    "stg_reviews": {
        "review_id": KEY,
        "user_id": REQUIRED,
        "product_id": REQUIRED,
        "rating": [*REQUIRED, accepted([1, 2, 3, 4, 5])],
    },
    "dim_customers": {
        "customer_key": REQUIRED,
        "customer_id": REQUIRED,
        "email": REQUIRED,
        "segment": [*REQUIRED, accepted(SEGMENTS)],
        "country": REQUIRED,
        "valid_from": REQUIRED,
        "valid_to": REQUIRED,
        "is_current": [*REQUIRED, accepted([0, 1])],
    },
    "dim_products": {
        "product_key": KEY,
        "product_id": KEY,
        "name": REQUIRED,
        "category": REQUIRED,
        "price": REQUIRED,
        "price_tier": [*REQUIRED, accepted(TIERS)],
        "sku": KEY,
    },
    "dim_vendors": {
        "vendor_key": KEY,
        "vendor_id": KEY,
        "name": REQUIRED,
        "category": REQUIRED,
        "payment_terms": [*REQUIRED, accepted(TERMS)],
    },
    "fct_orders": {
        "order_id": KEY,
        "customer_key": [*REQUIRED, refers("dim_customers", "customer_key")],
        "product_key": [*REQUIRED, refers("dim_products", "product_key")],
        "amount": REQUIRED,
        "status": [*REQUIRED, accepted(ORDER_STATUSES)],
        "order_date": REQUIRED,
        "customer_segment": [accepted(SEGMENTS)],
    },
    "fct_procurement": {
        "po_id": KEY,
        "vendor_key": [*REQUIRED, refers("dim_vendors", "vendor_key")],
        "amount": REQUIRED,
        "status": [*REQUIRED, accepted(PO_STATUSES)],
        "currency": REQUIRED,
    },
    "fct_reviews": {
        "review_id": KEY,
        "product_key": [*REQUIRED, refers("dim_products", "product_key")],
        "user_id": REQUIRED,
        "rating": [*REQUIRED, accepted([1, 2, 3, 4, 5])],
    },
    "stg_users": {
        "user_id": KEY,
        "email": REQUIRED,
        "plan": [*REQUIRED, accepted(PLANS)],
        "status": [*REQUIRED, accepted(["active", "cancelled", "trial", "suspended", "churned"])],
        "mrr": REQUIRED,
        "country": REQUIRED,
    },
    "stg_events": {
        "event_id": KEY,
        "user_id": REQUIRED,
        "event_type": [*REQUIRED, accepted(EVENT_TYPES)],
        "occurred_at": REQUIRED,
        "event_date": REQUIRED,
    },
    "stg_subscriptions": {
        "subscription_id": KEY,
        "user_id": [*REQUIRED, refers("stg_users", "user_id")],
        "plan": [*REQUIRED, accepted(PLANS)],
        "status": [*REQUIRED, accepted(["active", "cancelled", "trial", "expired"])],
        "mrr": REQUIRED,
        "billing_cycle": [*REQUIRED, accepted(["monthly", "annual", "quarterly"])],
    },
    "dim_users": {
        "user_id": KEY,
        "email": REQUIRED,
        "plan": [*REQUIRED, accepted(PLANS)],
        "status": REQUIRED,
        "mrr": REQUIRED,
        "country": REQUIRED,
    },
    "fct_daily_active_users": {"event_date": KEY, "dau": REQUIRED, "total_events": REQUIRED},
    "fct_event_funnel": {"event_type": KEY, "total_events": REQUIRED, "unique_users": REQUIRED},
}

MART_TESTS: dict[str, dict[str, list]] = {
    table: {column: REQUIRED for column in columns}
    for table, columns in {
        "fct_mrr": ["plan", "billing_cycle", "total_mrr", "total_subscribers"],
        "fct_weekly_active_users": ["user_id", "day", "cohort_day", "active_users_7d"],
        "fct_top_customers_by_spend": ["customer_id", "name", "total_spend"],
        "fct_customer_journey": ["email"],
        "fct_loyal_customers": ["customer_key", "full_name", "country", "total_revenue", "order_count"],
        "fct_mrr_by_plan": ["plan", "total_mrr"],
        "fct_monthly_revenue_trend_by_category": ["month", "category", "revenue"],
        "fct_rolling_revenue_by_category": ["product_category", "total_revenue"],
        "fct_customer_lifetime_value_by_segment": ["segment", "lifetime_value"],
        "fct_vendor_performance": ["vendor_key", "total_orders", "on_time_deliveries", "on_time_delivery_rate"],
        "mart_product_enrichment": ["product_id", "product_name", "enriched_at"],
        "fct_revenue_by_category": ["product_category", "order_month", "total_revenue"],
        "fct_customer_churn_rate": ["month", "churn_rate", "churned", "total"],
        "fct_monthly_revenue_by_category": ["month", "category", "revenue"],
        "fct_revenue_by_plan": ["plan", "month", "revenue"],
    }.items()
}
