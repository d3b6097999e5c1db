"""Analytic queries of the dashboards and of the query cook-book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import in_last
from stratalake.functions.text import percent_of
from stratalake.plans.marts import count_of, month_of, per_customer_revenue, revenue_sum, with_customer, with_product

REVENUE_DIMENSIONS = ["customer_country", "product_category", "customer_segment", "status"]


def annual_value() -> Column:
    return F.col("total_shopflow_revenue") + F.col("saas_mrr") * 12


def top(df: DataFrame, n: int, by: Column, *ties: str) -> DataFrame:
    return df.orderBy(by, *ties).limit(n)


# ---- joins -------------------------------------------------------------------------------------------


def join_orders_customers(fact: DataFrame, customers: DataFrame) -> DataFrame:
    joined = with_customer(per_customer_revenue(fact), customers, "segment", "country")
    return joined.groupBy("segment", "country").agg(revenue_sum())


def per_product_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("product_id").agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))


def join_orders_products(fact: DataFrame, products: DataFrame) -> DataFrame:
    joined = with_product(per_product_revenue(fact), products, "category", "price_tier")
    return joined.groupBy("category", "price_tier").agg(F.sum("orders").alias("orders"), revenue_sum())


def join_reviews_products(reviews: DataFrame, products: DataFrame) -> DataFrame:
    joined = with_product(reviews.select("product_id", "rating"), products, "category")
    return joined.groupBy("category").agg(F.round(F.avg("rating"), 2).alias("avg_rating"), F.count("*").alias("reviews"))


def join_procurement_vendors(procurement: DataFrame, vendors: DataFrame) -> DataFrame:
    """Spend and mean lead time per vendor; sums per vendor id are joined, not single orders."""
    totals = procurement.groupBy("vendor_id").agg(
        F.sum("amount").alias("spend"), F.sum("lead_time_days").alias("days"), F.count("lead_time_days").alias("n")
    )
    joined = totals.join(vendors.select("vendor_id", "name", "country"), "vendor_id")
    return joined.groupBy("name", "country").agg(
        F.round(F.sum("spend"), 2).alias("spend"), F.try_divide(F.sum("days"), F.sum("n")).alias("avg_lead_days")
    )


def join_enrichment(fact: DataFrame, products: DataFrame, enrichment: DataFrame, attribute: str = "sentiment") -> DataFrame:
    """Orders to products to enrichment: revenue and orders by an enrichment attribute."""
    joined = with_product(per_product_revenue(fact), products).join(enrichment.select("product_id", attribute), "product_id")
    return joined.groupBy(attribute).agg(revenue_sum(), F.sum("orders").alias("orders"))


def left_join_current(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders per segment of the current version; the version test is part of the join condition."""
    who = customers.select("customer_id", "segment", "is_current")
    matched = (fact["customer_id"] == who["customer_id"]) & (who["is_current"] == 1)
    return fact.join(who, matched, "left").groupBy("segment").agg(F.count("*").alias("orders"))


# ---- aggregates --------------------------------------------------------------------------------------


def kpi_totals(fact: DataFrame, users: DataFrame, mrr: DataFrame) -> DataFrame:
    """One row: completed revenue, orders, active users, monthly recurring revenue."""
    orders = fact.agg(
        F.sum(F.when(F.col("status") == "completed", F.col("revenue"))).alias("total_revenue"),
        F.count("*").alias("total_orders"),
    )
    active = users.agg(count_of("status", "active").alias("active_users")).scalar()
    recurring = mrr.agg(F.sum("total_mrr").alias("total_mrr")).scalar()
    return orders.withColumns({"active_users": active, "total_mrr": recurring})


def monthly_revenue(fact: DataFrame) -> DataFrame:
    done = fact.filter((F.col("status") == "completed") & F.col("order_date").isNotNull())
    return done.groupBy(month_of("order_date").alias("month")).agg(F.sum("revenue").alias("revenue"))


def category_summary(fact: DataFrame, n: int = 10) -> DataFrame:
    known = fact.filter(F.col("product_category").isNotNull())
    totals = known.groupBy(F.col("product_category").alias("category")).agg(
        F.count("*").alias("orders"),
        F.sum("revenue").alias("revenue"),
        F.round(F.avg("revenue"), 2).alias("avg_order_value"),
    )
    return top(totals, n, F.desc("revenue"), "category")


def cross_domain_kpis(unified: DataFrame) -> DataFrame:
    both = unified.filter(F.col("customer_type") == "cross_domain")
    return both.agg(
        F.count("*").alias("customers"),
        F.sum("saas_mrr").alias("mrr"),
        F.round(F.avg(annual_value()), 2).alias("avg_annual_value"),
    )


def customer_type_breakdown(unified: DataFrame) -> DataFrame:
    return unified.groupBy("customer_type").agg(
        F.count("*").alias("customers"),
        F.round(F.sum("saas_mrr"), 2).alias("total_saas_mrr"),
        F.round(F.sum("total_shopflow_revenue"), 2).alias("total_shopflow_rev"),
        F.round(F.sum(annual_value()), 2).alias("annual_value"),
    )


def revenue_by(fact: DataFrame, dimension: str) -> DataFrame:
    return fact.groupBy(dimension).agg(revenue_sum(), F.count("*").alias("orders"))


def revenue_by_all(fact: DataFrame) -> DataFrame:
    """All four breakdowns in one pass over the fact: (dimension, value, revenue, orders)."""
    singles = [[F.col(d)] for d in REVENUE_DIMENSIONS]
    grouped = fact.groupingSets(singles, *[F.col(d) for d in REVENUE_DIMENSIONS]).agg(
        revenue_sum(), F.count("*").alias("orders"), F.grouping_id().alias("gid")
    )
    # The grouping id has a 0 bit at the place of the grouped column.
    full = 2 ** len(REVENUE_DIMENSIONS) - 1
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for place, dim in enumerate(reversed(REVENUE_DIMENSIONS)):
        here = F.col("gid") == full - 2**place
        name, value = F.when(here, F.lit(dim)).otherwise(name), F.when(here, F.col(dim)).otherwise(value)
    return grouped.select(name.alias("dimension"), value.alias("value"), "revenue", "orders")


def avg_dau_by_month(dau: DataFrame) -> DataFrame:
    return dau.groupBy(month_of("event_date").alias("month")).agg(F.round(F.avg("dau"), 0).alias("avg_dau"))


def dau_series(dau: DataFrame, days: int, as_of) -> DataFrame:
    recent = dau.filter(in_last(F.col("event_date"), days, "day", as_of))
    return recent.select("event_date", "dau", "total_events", "logins", "signups")


def churn_pct(users: DataFrame) -> DataFrame:
    totals = users.agg(F.count_if(F.col("is_churned") == 1).alias("churned"), F.count("*").alias("total"))
    return totals.select(percent_of(F.col("churned"), F.col("total")).alias("churn_pct"), "churned", "total")


def paying_by_plan(users: DataFrame) -> DataFrame:
    paying = users.filter((F.col("is_churned") == 0) & (F.col("is_free") == 0))
    return paying.groupBy("plan").agg(F.count("*").alias("subscribers"), F.round(F.sum("mrr"), 2).alias("mrr"))


def sentiment_distribution(enrichment: DataFrame, products: DataFrame) -> DataFrame:
    joined = with_product(enrichment.select("product_id", "sentiment"), products, "price")
    return joined.groupBy("sentiment").agg(F.count("*").alias("products"), F.round(F.avg("price"), 2).alias("avg_price"))


def worst_categories(enrichment: DataFrame, n: int = 10) -> DataFrame:
    totals = enrichment.groupBy("original_category").agg(count_of("sentiment", "negative").alias("negative_products"))
    return top(totals, n, F.desc("negative_products"), "original_category")


def mrr_table(mrr: DataFrame) -> DataFrame:
    return mrr.select("plan", "billing_cycle", "total_subscribers", "active_subscribers", "churned_subscribers", "total_mrr")


# ---- bronze roll-ups ---------------------------------------------------------------------------------


def rows_by(bronze: DataFrame, column: str) -> DataFrame:
    return bronze.groupBy(column).agg(F.count("*").alias("rows"))


def monthly_amount(bronze_orders: DataFrame) -> DataFrame:
    return bronze_orders.groupBy(month_of("order_date").alias("month")).agg(F.sum("amount").alias("revenue"))


def top_spenders(bronze_orders: DataFrame, n: int = 10) -> DataFrame:
    totals = bronze_orders.groupBy("customer_id").agg(F.sum("amount").alias("total"))
    return top(totals, n, F.desc("total"), "customer_id")


# ---- top-k -------------------------------------------------------------------------------------------


def top_products(fact: DataFrame, n: int = 10) -> DataFrame:
    totals = fact.groupBy("product_name", "product_category").agg(F.count("*").alias("orders"), F.sum("revenue").alias("revenue"))
    return top(totals, n, F.desc("revenue"), "product_name", "product_category")


def top_cross_domain(unified: DataFrame, n: int = 20) -> DataFrame:
    both = unified.filter(F.col("customer_type") == "cross_domain")
    shown = both.select(
        "email",
        "full_name",
        F.col("saas_plan").alias("plan"),
        F.round("saas_mrr", 2).alias("saas_mrr"),
        F.round("total_shopflow_revenue", 2).alias("total_shopflow_revenue"),
        F.round(annual_value(), 2).alias("annual_value"),
    )
    return top(shown, n, F.desc("annual_value"), "email")
