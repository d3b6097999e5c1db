"""Typed bronze views over landing files. Lazy: nothing is copied.

Money becomes ``decimal(18,2)``; a landing file may hold a timestamp as text or as a timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import parse_timestamp
from stratalake.functions.values import money

DELETED = "_ab_cdc_deleted_at"
EXTRACTED = "_airbyte_extracted_at"


def not_deleted(df: DataFrame, marker: str = DELETED) -> DataFrame:
    """Drop soft-deleted rows: the marker is NULL or empty on live rows."""
    return df.filter(F.col(marker).isNull() | (F.col(marker) == ""))


def _text(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("string") for n in names}


def _number(kind: str, *names: str) -> dict[str, Column]:
    return {n: F.col(n).try_cast(kind) for n in names}


def _moment(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("timestamp") for n in names}


def _loose_moment(raw: DataFrame, *names: str) -> dict[str, Column]:
    """Text is parsed as well as it can be; a landing column that is a moment already is taken over."""
    is_text = lambda n: raw.schema[n].dataType.typeName() == "string"
    return {n: parse_timestamp(F.col(n)) if is_text(n) else F.col(n).cast("timestamp") for n in names}


def _project(df: DataFrame, *groups: dict[str, Column], order: list[str]) -> DataFrame:
    cols = {k: v for g in groups for k, v in g.items()}
    return df.select([cols[name].alias(name) for name in order])


def _cdc_view(raw: DataFrame, key: str, *groups: dict[str, Column], order: list[str]) -> DataFrame:
    live = not_deleted(raw.filter(F.col(key).isNotNull()))
    return _project(live, *groups, _text(DELETED), _moment(EXTRACTED), order=[*order, DELETED, EXTRACTED])


def bronze_customers(raw: DataFrame) -> DataFrame:
    return _cdc_view(
        raw,
        "customer_id",
        _number("bigint", "customer_id"),
        _text("first_name", "last_name", "phone", "segment", "country", "city"),
        {"email": F.lower(F.col("email").cast("string"))},
        _moment("created_at", "updated_at"),
        order=["customer_id", "first_name", "last_name", "email", "phone", "segment", "country", "city", "created_at", "updated_at"],
    )


def bronze_orders(raw: DataFrame) -> DataFrame:
    return _cdc_view(
        raw,
        "order_id",
        _number("bigint", "order_id", "customer_id", "product_id"),
        {"amount": money(F.col("amount"))},
        _number("int", "quantity"),
        _text("status"),
        _moment("order_date", "updated_at"),
        order=["order_id", "customer_id", "product_id", "amount", "quantity", "status", "order_date", "updated_at"],
    )


def bronze_products(raw: DataFrame) -> DataFrame:
    return _cdc_view(
        raw,
        "product_id",
        _number("bigint", "product_id"),
        _text("name", "category", "sku"),
        {"price": money(F.col("price"))},
        _number("int", "stock_qty"),
        _moment("created_at", "updated_at"),
        order=["product_id", "name", "category", "price", "stock_qty", "sku", "created_at", "updated_at"],
    )


def bronze_vendors(raw: DataFrame) -> DataFrame:
    return _project(
        raw.filter(F.col("vendor_id") != ""),
        _text("vendor_id", "name", "contact_name", "phone", "country", "city", "category", "payment_terms"),
        {"email": F.lower(F.col("email").cast("string")), "is_active": F.col("is_active").cast("int")},
        _loose_moment(raw, "created_at", "updated_at"),
        order=["vendor_id", "name", "contact_name", "email", "phone", "country", "city", "category", "payment_terms", "is_active", "created_at", "updated_at"],
    )


def bronze_purchase_orders(raw: DataFrame) -> DataFrame:
    return _project(
        raw.filter(F.col("po_id") != ""),
        _text("po_id", "vendor_id", "currency", "status", "description", "requested_by"),
        {"amount": money(F.col("amount"))},
        _number("int", "line_items"),
        _loose_moment(raw, "po_date", "delivery_date", "created_at", "updated_at"),
        order=["po_id", "vendor_id", "amount", "currency", "status", "line_items", "description", "requested_by", "po_date", "delivery_date", "created_at", "updated_at"],
    )


def _json_text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType.typeName()
    return F.to_json(name) if kind in ("struct", "map", "array") else F.col(name).cast("string")


def bronze_rest_users(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("id").isNotNull()).select(
        F.col("id").cast("bigint").alias("user_id"),
        F.col("name").cast("string").alias("name"),
        F.lower(F.col("email").cast("string")).alias("email"),
        *[F.col(c).cast("string").alias(c) for c in ("username", "phone", "website")],
        _json_text(raw, "address").alias("address_json"),
        _json_text(raw, "company").alias("company_json"),
    )


def bronze_rest_posts(raw: DataFrame) -> DataFrame:
    live = raw.filter(F.col("id").isNotNull()).select("id", "userId", "title", "body")
    typed = live.withColumns({"id": F.col("id").cast("bigint"), "userId": F.col("userId").cast("bigint")})
    return typed.withColumnsRenamed({"id": "post_id", "userId": "user_id"})


def bronze_rest_comments(raw: DataFrame) -> DataFrame:
    live = raw.filter(F.col("id").isNotNull()).select("id", "postId", "name", "email", "body")
    typed = live.withColumns(
        {"id": F.col("id").cast("bigint"), "postId": F.col("postId").cast("bigint"), "email": F.lower("email")}
    )
    return typed.withColumnsRenamed({"id": "comment_id", "postId": "post_id"})
