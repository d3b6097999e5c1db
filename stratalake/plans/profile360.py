"""Cross-domain customer profile: store customers and subscription users, matched by e-mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import as_timestamp
from stratalake.operators.scd import current_only

PROFILE_COLUMNS = [
    "email", "customer_id", "user_id", "full_name", "shopflow_segment", "shopflow_country", "shopflow_city",
    "shopflow_order_count", "total_shopflow_revenue", "saas_plan", "saas_mrr", "saas_status", "saas_company",
    "saas_country", "is_churned",
]


def order_aggregates(orders_fact: DataFrame) -> DataFrame:
    """Order count and revenue per customer."""
    return orders_fact.groupBy("customer_id").agg(
        F.count("*").alias("shopflow_order_count"), F.sum("revenue").cast("double").alias("total_shopflow_revenue")
    )


def unified_customers(customers: DataFrame, users: DataFrame, orders_fact: DataFrame, as_of) -> DataFrame:
    """Everybody on either side, matched on the normalised e-mail; ``customer_type`` tells which sides a person is on.

    The full outer join is written as a left join plus the users without a store e-mail: unlike a full
    outer join, a left join can be split by adaptive execution when one e-mail holds very many rows.
    """
    email = F.lower(F.trim("email")).alias("email")
    current = current_only(customers)
    store = current.select(
        "customer_id",
        email,
        "full_name",
        F.col("segment").alias("shopflow_segment"),
        F.col("country").alias("shopflow_country"),
        F.col("city").alias("shopflow_city"),
    ).join(order_aggregates(orders_fact), "customer_id", "left")
    saas = users.select(
        "user_id",
        email,
        F.col("plan").alias("saas_plan"),
        F.col("mrr").alias("saas_mrr"),
        F.col("status").alias("saas_status"),
        F.col("company").alias("saas_company"),
        F.col("country").alias("saas_country"),
        "is_churned",
    )
    matched = store.join(saas, "email", "left")
    saas_only = saas.join(current.select(email).distinct(), "email", "left_anti")
    everybody = matched.unionByName(saas_only, allowMissingColumns=True).fillna(
        {"saas_mrr": 0.0, "is_churned": 0, "shopflow_order_count": 0, "total_shopflow_revenue": 0.0}
    )
    in_store, in_saas = F.col("customer_id").isNotNull(), F.col("user_id").isNotNull()
    kind = F.when(in_store & in_saas, "cross_domain").when(in_store, "shopflow_only").otherwise("saas_only")
    return everybody.select(*PROFILE_COLUMNS, kind.alias("customer_type"), as_timestamp(as_of).alias("profiled_at"))
