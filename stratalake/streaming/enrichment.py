"""Product enrichment: rules or an external classifier, joined back to the raw rows, refreshed into a mart."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.text import first_tags
from stratalake.functions.dates import as_timestamp
from stratalake.operators.dedup import collapse_versions
from stratalake.operators.incremental import incremental_upsert
from stratalake.sources.versioned import BATCH, write_batch
from stratalake.streaming.cdc import latest_in_batch, unwrap_cdc

# Price limits of the tiers, defaults when nothing better is known, number of tags.
PREMIUM_ABOVE, BUDGET_BELOW = 100, 20
DEFAULT_SENTIMENT, DEFAULT_TIER, DEFAULT_CATEGORY = "neutral", "standard", "Unknown"
MAX_TAGS = 5
CLASSIFY_BATCH = 10
ENRICHED = "product_id bigint, sentiment string, quality_tier string, enriched_category string, keywords array<string>"
ANSWER = ["product_id", "sentiment", "quality_tier", "enriched_category", "keywords"]
MART_COLUMNS = [
    "product_id", "product_name", "original_category", "enriched_category", "sentiment", "quality_tier", "keywords", "enriched_at",
]

Classifier = Callable[[pd.DataFrame], pd.DataFrame]


def quality_tier(price: Column) -> Column:
    return F.when(price > PREMIUM_ABOVE, "premium").when(price < BUDGET_BELOW, "budget").otherwise(DEFAULT_TIER)


def _defaults(products: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(
        {
            "product_id": products["product_id"],
            "sentiment": DEFAULT_SENTIMENT,
            "quality_tier": DEFAULT_TIER,
            "enriched_category": products["category"].fillna(DEFAULT_CATEGORY),
            "keywords": [[] for _ in range(len(products))],
        }
    )


def enrich_products(
    products: DataFrame, classify: Classifier | None = None, batch_size: int = CLASSIFY_BATCH, tasks: int | None = None
) -> DataFrame:
    """Sentiment, tier, finer category and tags per product.

    ``classify`` gets at most ``batch_size`` products at a time as a pandas frame (product_id, name,
    category, price); a call that fails gives the defaults for its products. Calls take long and rows are small, so
    ``tasks`` deals the products out over that many tasks, however few bytes they have. Without a classifier the price
    rule runs as plain columns.
    """
    if classify is None:
        return products.select(
            "product_id",
            F.lit(DEFAULT_SENTIMENT).alias("sentiment"),
            quality_tier(F.col("price")).alias("quality_tier"),
            F.coalesce("category", F.lit(DEFAULT_CATEGORY)).alias("enriched_category"),
            F.array().cast("array<string>").alias("keywords"),
        )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            answers = {c: [] for c in ANSWER}
            for start in range(0, len(batch), batch_size):
                part = batch.iloc[start : start + batch_size]
                try:
                    answer = classify(part)
                    values = [answer[c].tolist() for c in ANSWER]
                except Exception:  # an external call: any failure means defaults, the stream goes on
                    answer = _defaults(part)
                    values = [answer[c].tolist() for c in ANSWER]
                for c, given in zip(ANSWER, values):
                    answers[c].extend(given)
            yield pd.DataFrame(answers)  # together: a hand-over costs more than many small calls

    asked = products.select("product_id", "name", "category", "price")
    return (asked.repartition(tasks, "product_id") if tasks else asked).mapInPandas(run, ENRICHED)


def attach_raw(enriched: DataFrame, raw: DataFrame, enriched_at) -> DataFrame:
    """Mart-shaped rows: name and original category from the raw row, missing answers filled."""
    names = raw.select("product_id", "name", "category")
    moment = enriched_at if isinstance(enriched_at, Column) else as_timestamp(enriched_at)
    joined = enriched.join(names, "product_id", "left")
    original = F.coalesce("category", "enriched_category", F.lit(DEFAULT_CATEGORY))
    return joined.select(
        "product_id",
        F.coalesce("name", F.lit("")).alias("product_name"),
        original.alias("original_category"),
        F.coalesce("enriched_category", original).alias("enriched_category"),
        F.coalesce("sentiment", F.lit(DEFAULT_SENTIMENT)).alias("sentiment"),
        F.coalesce("quality_tier", F.lit(DEFAULT_TIER)).alias("quality_tier"),
        first_tags(F.coalesce("keywords", F.array().cast("array<string>")), MAX_TAGS).alias("keywords"),
        moment.alias("enriched_at"),
    )


def enrich_messages(messages: DataFrame, enriched_at, classify: Classifier | None = None) -> DataFrame:
    """Messages to mart-shaped rows: unwrap, keep the last image per product, enrich, join back."""
    raw = latest_in_batch(unwrap_cdc(messages))
    return attach_raw(enrich_products(raw, classify), raw, enriched_at)


def mart_product_enrichment(raw: DataFrame, target: DataFrame | None = None) -> DataFrame:
    """Newest enrichment per product; with a target only rows after its newest minus one hour are merged."""
    rows = raw.select(*MART_COLUMNS)
    if target is None:
        return collapse_versions(rows, ["product_id"], "enriched_at", "sentiment")
    return incremental_upsert(
        target, rows, ["product_id"], "enriched_at", floor=None, strict=True, dedupe=["enriched_at", "sentiment"]
    )


def refresh_mart(raw_path: str, mart_path: str) -> Callable[[SparkSession, int], None]:
    """After-batch step: bring the rows of the new raw batch into the versioned mart.

    Only that batch's folder is read and only the same batch of the mart is written, so a refresh costs what the batch holds. A
    replayed batch overwrites its own; late rows lose to newer versions when the mart is read.
    """

    def run(spark: SparkSession, batch_id: int) -> None:
        raw = spark.read.parquet(f"{raw_path}/{BATCH}={batch_id}").select(*MART_COLUMNS)
        write_batch(collapse_versions(raw, ["product_id"], "enriched_at", "sentiment"), mart_path, batch_id)

    return run
