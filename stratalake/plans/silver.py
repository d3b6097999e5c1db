"""Silver and staging models: validity filters, cleaning, latest image per id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import as_timestamp, days_between
from stratalake.functions.text import empty_to_null, title_case, whitelist
from stratalake.functions.values import amount_if, money, price_tier, synthetic_bucket
from stratalake.operators.dedup import dedup_latest

# Accepted vocabularies and their defaults.
SEGMENTS, DEFAULT_SEGMENT = ["B2B", "B2C", "VIP"], "B2C"
ORDER_STATUSES, DEFAULT_ORDER_STATUS = ["pending", "completed", "cancelled"], "pending"
PO_STATUSES, DEFAULT_PO_STATUS = ["OPEN", "APPROVED", "RECEIVED", "CLOSED", "CANCELLED"], "OPEN"
FULFILLED_STATUSES = ["CLOSED", "RECEIVED"]
REVIEWED_PRODUCTS = 200


def valid_rows(df: DataFrame, positive: Sequence[str] = (), non_empty: Sequence[str] = ()) -> DataFrame:
    """Conjunction of ``> 0`` and ``<> ''`` tests; NULL fails both."""
    for name in positive:
        df = df.filter(F.col(name) > 0)
    for name in non_empty:
        df = df.filter(F.col(name) != "")
    return df


def _trimmed(*names: str) -> list[Column]:
    return [F.trim(n).alias(n) for n in names]


def stg_customers(bronze: DataFrame, as_of) -> DataFrame:
    valid = valid_rows(bronze, ["customer_id"], ["email"]).filter(F.col("email").like("%@%"))
    latest = dedup_latest(valid, ["customer_id"], ["updated_at", "created_at", "email"])
    return latest.select(
        "customer_id",
        *_trimmed("first_name", "last_name"),
        F.concat(F.trim("first_name"), F.lit(" "), F.trim("last_name")).alias("full_name"),
        F.lower(F.trim("email")).alias("email"),
        empty_to_null(F.col("phone")).alias("phone"),
        whitelist(F.col("segment"), SEGMENTS, DEFAULT_SEGMENT).alias("segment"),
        F.upper(F.trim("country")).alias("country"),
        empty_to_null(F.col("city")).alias("city"),
        "created_at",
        "updated_at",
        F.to_date("created_at").alias("created_date"),
        days_between(F.col("created_at"), as_timestamp(as_of)).alias("days_since_signup"),
    )


def stg_orders(bronze: DataFrame, require_product: bool = True) -> DataFrame:
    """Orders. ``require_product=False`` keeps orders whose product is unknown."""
    positive = ["order_id", "customer_id", "amount"] + (["product_id"] if require_product else [])
    latest = dedup_latest(valid_rows(bronze, positive), ["order_id"], ["updated_at", "order_date", "amount"])
    status = F.lower("status")
    return latest.select(
        "order_id",
        "customer_id",
        "product_id",
        money(F.col("amount")).alias("amount"),
        "quantity",
        whitelist(F.col("status"), ORDER_STATUSES, DEFAULT_ORDER_STATUS, case=F.lower).alias("status"),
        "order_date",
        "updated_at",
        F.to_date("order_date").alias("order_date_day"),
        F.trunc("order_date", "month").alias("order_month"),
        F.year("order_date").alias("order_year"),
        amount_if(status, ["completed"], F.col("amount")).alias("revenue"),
    )


def stg_products(bronze: DataFrame) -> DataFrame:
    valid = valid_rows(bronze, ["product_id", "price"], ["name"])
    latest = dedup_latest(valid, ["product_id"], ["updated_at", "created_at", "sku"])
    return latest.select(
        "product_id",
        F.trim("name").alias("name"),
        title_case(F.trim("category")).alias("category"),
        money(F.col("price")).alias("price"),
        F.when(F.col("stock_qty") < 0, 0).otherwise(F.col("stock_qty")).alias("stock_qty"),
        F.upper(F.trim("sku")).alias("sku"),
        price_tier(F.col("price")).alias("price_tier"),
        "created_at",
        "updated_at",
    )


def stg_purchase_orders(bronze: DataFrame, dedupe: bool = False) -> DataFrame:
    """Purchase orders; several images of one id are kept unless ``dedupe`` is set."""
    valid = valid_rows(bronze, ["amount"], ["po_id", "vendor_id"])
    if dedupe:
        valid = dedup_latest(valid, ["po_id"], ["updated_at", "po_date", "amount"])
    status = F.upper("status")
    return valid.select(
        "po_id",
        "vendor_id",
        money(F.col("amount")).alias("amount"),
        F.upper(F.trim("currency")).alias("currency"),
        whitelist(F.col("status"), PO_STATUSES, DEFAULT_PO_STATUS).alias("status"),
        "line_items",
        *_trimmed("description", "requested_by"),
        "po_date",
        "delivery_date",
        "created_at",
        "updated_at",
        F.to_date("po_date").alias("po_date_day"),
        days_between(F.col("po_date"), F.col("delivery_date")).alias("lead_time_days"),
        amount_if(status, FULFILLED_STATUSES, F.col("amount")).alias("fulfilled_amount"),
    )


def stg_reviews(bronze_posts: DataFrame, as_of) -> DataFrame:
    """Posts as product reviews: product and rating follow from the post id."""
    valid = valid_rows(bronze_posts, ["post_id", "user_id"], ["body"])
    return valid.select(
        F.col("post_id").alias("review_id"),
        "user_id",
        synthetic_bucket(F.col("post_id"), REVIEWED_PRODUCTS).alias("product_id"),
        F.trim("title").alias("summary"),
        F.trim("body").alias("review_text"),
        (F.col("post_id") % 5 + 1).alias("rating"),
        as_timestamp(as_of).alias("created_at"),
    )


def stg_vendors(bronze: DataFrame) -> DataFrame:
    return valid_rows(bronze, [], ["vendor_id", "name"]).select(
        "vendor_id",
        *_trimmed("name", "contact_name"),
        F.lower(F.trim("email")).alias("email"),
        empty_to_null(F.col("phone")).alias("phone"),
        F.upper(F.trim("country")).alias("country"),
        empty_to_null(F.col("city")).alias("city"),
        title_case(F.trim("category")).alias("category"),
        F.upper(F.trim("payment_terms")).alias("payment_terms"),
        "is_active",
        "created_at",
        "updated_at",
    )


def stg_events(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("user_id").isNotNull()).select(
        F.col("id").alias("event_id"),
        "user_id",
        "event_type",
        "page",
        "occurred_at",
        F.to_date("occurred_at").alias("event_date"),
    )


def stg_subscriptions(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("user_id").isNotNull()).select(
        F.col("id").alias("subscription_id"),
        "user_id",
        F.lower("plan").alias("plan"),
        F.col("amount").alias("mrr"),
        "billing_cycle",
        "started_at",
        F.col("expires_at").alias("ended_at"),
        F.lower("status").alias("status"),
    )


def stg_users(raw: DataFrame, as_of) -> DataFrame:
    known = raw.filter((F.col("email") != "") & F.col("id").isNotNull())
    return known.select(
        F.col("id").alias("user_id"),
        "email",
        F.lower("plan").alias("plan"),
        "mrr",
        F.lower("status").alias("status"),
        "country",
        "company",
        "created_at",
        "updated_at",
        days_between(F.col("created_at"), as_timestamp(as_of)).alias("days_since_signup"),
    )
