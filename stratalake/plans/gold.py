"""Gold dimensions and facts.

Surrogate keys are MD5 texts of natural ids, so facts join dimensions on the narrow natural id and only
carry the MD5 along: the result is the same and the shuffle is half as wide.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.values import surrogate_key, version_of
from stratalake.operators.dedup import dedup_latest
from stratalake.operators.scd import current_only, scd2_init


def dim_customers(stg: DataFrame) -> DataFrame:
    keyed = stg.filter(F.col("customer_id").isNotNull()).select(
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        *[c for c in stg.columns if c not in ("created_date",)],
        version_of(F.col("updated_at"), F.col("created_at")).alias("version"),
    )
    return scd2_init(keyed, "created_at").drop("created_at")


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.select(
        surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id",
        "name",
        "category",
        "price",
        "price_tier",
        F.col("stock_qty").alias("current_stock_quantity"),
        "sku",
        (F.col("stock_qty") != 0).cast("int").alias("is_in_stock"),
        "created_at",
        "updated_at",
        version_of(F.col("updated_at")).alias("version"),
    )


def dim_vendors(stg: DataFrame) -> DataFrame:
    return stg.select(
        surrogate_key(F.col("vendor_id")).alias("vendor_key"),
        *stg.columns,
        version_of(F.col("updated_at")).alias("version"),
    )


def dim_users(users: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One row per user with the latest subscription (by start, then id)."""
    latest = dedup_latest(subscriptions, ["user_id"], ["started_at", "subscription_id"])
    joined = users.join(latest.select("user_id", "billing_cycle", "ended_at"), "user_id", "left")
    return joined.select(
        "user_id",
        "email",
        "plan",
        "mrr",
        "status",
        "country",
        "company",
        "created_at",
        "days_since_signup",
        "billing_cycle",
        "ended_at",
        (F.col("status") == "churned").cast("int").alias("is_churned"),
        (F.col("plan") == "free").cast("int").alias("is_free"),
    )


def fct_orders(orders: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Orders with the attributes of the current customer version and of the product."""
    who = current_only(customers).select(
        "customer_id", F.col("segment").alias("customer_segment"), F.col("country").alias("customer_country")
    )
    what = products.select(
        "product_id",
        F.col("category").alias("product_category"),
        F.col("price_tier").alias("product_price_tier"),
        F.col("name").alias("product_name"),
    )
    joined = orders.join(who, "customer_id", "left").join(what, "product_id", "left")
    return joined.select(
        "order_id",
        surrogate_key(F.col("customer_id")).alias("customer_key"),
        surrogate_key(F.col("product_id")).alias("product_key"),
        "customer_id",
        "product_id",
        "amount",
        "quantity",
        "revenue",
        "status",
        "order_date",
        "order_date_day",
        "order_month",
        "order_year",
        "updated_at",
        "customer_segment",
        "customer_country",
        "product_category",
        "product_price_tier",
        "product_name",
    )


def fct_procurement(purchase_orders: DataFrame, vendors: DataFrame) -> DataFrame:
    who = vendors.select(
        "vendor_id",
        F.col("name").alias("vendor_name"),
        F.col("country").alias("vendor_country"),
        F.col("category").alias("vendor_category"),
        "payment_terms",
    )
    return purchase_orders.join(who, "vendor_id", "left").select(
        "po_id",
        surrogate_key(F.col("vendor_id")).alias("vendor_key"),
        "vendor_id",
        "amount",
        "fulfilled_amount",
        "line_items",
        "lead_time_days",
        "status",
        "currency",
        "requested_by",
        "description",
        "po_date",
        "po_date_day",
        "delivery_date",
        "updated_at",
        "vendor_name",
        "vendor_country",
        "vendor_category",
        "payment_terms",
    )


def fct_reviews(reviews: DataFrame, products: DataFrame) -> DataFrame:
    what = products.select(
        "product_id", F.col("name").alias("product_name"), F.col("category").alias("product_category"), "price_tier"
    )
    return reviews.join(what, "product_id", "left").select(
        "review_id",
        "user_id",
        surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id",
        "rating",
        "summary",
        "review_text",
        "created_at",
        "product_name",
        "product_category",
        "price_tier",
    )
