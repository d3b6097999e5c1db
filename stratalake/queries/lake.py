"""All models over the given tables, as lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.plans import gold, marts, profile360, silver
from stratalake.session import prepare, scratch_path
from stratalake.sources import bronze
from stratalake.sources.driver_tables import EVENTS_AS_OF, ORDERS_AS_OF, DriverTables
from stratalake.streaming.enrichment import mart_product_enrichment


class Lake(DriverTables):
    """Bronze to gold; every attribute is a plan, nothing runs until a query does."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__(prepare(spark), sf_dir)
        self.written: dict[str, DataFrame] = {}

    bronze_customers = cached_property(lambda self: bronze.bronze_customers(self.raw_customers))
    bronze_orders = cached_property(lambda self: bronze.bronze_orders(self.raw_orders))
    bronze_products = cached_property(lambda self: bronze.bronze_products(self.raw_products))
    bronze_vendors = cached_property(lambda self: bronze.bronze_vendors(self.raw_vendors))
    bronze_purchase_orders = cached_property(lambda self: bronze.bronze_purchase_orders(self.raw_purchase_orders))
    bronze_posts = cached_property(lambda self: bronze.bronze_rest_posts(self.raw_rest_posts))

    stg_customers = cached_property(lambda self: silver.stg_customers(self.bronze_customers, ORDERS_AS_OF))
    stg_orders = cached_property(lambda self: silver.stg_orders(self.bronze_orders))
    stg_products = cached_property(lambda self: silver.stg_products(self.bronze_products))
    stg_vendors = cached_property(lambda self: silver.stg_vendors(self.bronze_vendors))
    stg_purchase_orders = cached_property(lambda self: silver.stg_purchase_orders(self.bronze_purchase_orders))
    stg_reviews = cached_property(lambda self: silver.stg_reviews(self.bronze_posts, EVENTS_AS_OF))
    stg_events = cached_property(lambda self: silver.stg_events(self.raw_saas_events))
    stg_subscriptions = cached_property(lambda self: silver.stg_subscriptions(self.raw_saas_subscriptions))
    stg_users = cached_property(lambda self: silver.stg_users(self.raw_saas_users, EVENTS_AS_OF))

    dim_customers = cached_property(lambda self: gold.dim_customers(self.stg_customers))
    dim_products = cached_property(lambda self: gold.dim_products(self.stg_products))
    dim_vendors = cached_property(lambda self: gold.dim_vendors(self.stg_vendors))
    dim_users = cached_property(lambda self: gold.dim_users(self.stg_users, self.stg_subscriptions))
    fct_orders = cached_property(lambda self: gold.fct_orders(self.stg_orders, self.dim_customers, self.dim_products))
    fct_procurement = cached_property(lambda self: gold.fct_procurement(self.stg_purchase_orders, self.dim_vendors))
    fct_reviews = cached_property(lambda self: gold.fct_reviews(self.stg_reviews, self.dim_products))
    fct_dau = cached_property(lambda self: marts.fct_daily_active_users(self.stg_events))
    fct_mrr = cached_property(lambda self: marts.fct_mrr(self.stg_subscriptions))
    fct_funnel = cached_property(lambda self: marts.fct_event_funnel(self.stg_events))
    mart_enrichment = cached_property(lambda self: mart_product_enrichment(self.products_enriched))
    unified = cached_property(
        lambda self: profile360.unified_customers(self.dim_customers, self.dim_users, self.fct_orders, ORDERS_AS_OF)
    )

    def stored(self, root: str, names: list[str], columns: Mapping[str, Sequence[str]] | None = None) -> Lake:
        """A lake whose named tables are written below ``root`` and read from there.

        Name them in dependency order: every table is built on the ones written before it. Tables that this lake reads from
        somewhere already stay as they are. ``columns`` names the columns to write of a table that is read for few of them.
        """
        out = type(self)(self.spark, self.dir)
        out.written = dict(self.written)
        out.__dict__.update(out.written)
        for name in names:
            if name not in out.written:
                df = getattr(out, name)
                df = df.select(*columns[name]) if columns and name in columns else df
                df.write.mode("overwrite").parquet(f"{root}/{name}")
                out.__dict__[name] = out.written[name] = self.spark.read.schema(df.schema).parquet(f"{root}/{name}")
        return out

    def with_dimensions(self, *names: str) -> Lake:
        """A lake whose named dimensions are written to the shared folder first.

        Spark then knows their real size when it plans a join with a fact (the estimate of a join's result is the product of its
        sides) and keeps the fact where it is if the dimension is small.
        """
        return self.stored(scratch_path(self.spark, "dimensions"), list(names))

    @property
    def gold_tables(self) -> dict[str, DataFrame]:
        return {
            "fct_orders": self.fct_orders,
            "fct_procurement": self.fct_procurement,
            "fct_reviews": self.fct_reviews,
            "dim_customers": self.dim_customers,
            "dim_products": self.dim_products,
            "dim_vendors": self.dim_vendors,
        }


def shown(df: DataFrame) -> DataFrame:
    """Plain column types for comparison with another engine: decimals as doubles, moments without zone."""
    cols = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            col = col.cast("timestamp_ntz")
        elif isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            col = F.array_join(col, "|")
        cols.append(col.alias(field.name))
    return df.select(cols)
