"""The corpus pipeline: five stages over ``documents``, each working on all that the one before kept.

The quality classifier drops what it rejects, near-dedup keeps one document of each group, decontamination drops documents that
hold benchmark passages, personal data are replaced in the texts, and mixing repeats or drops documents to meet the target
shares. Every stage is written as Parquet in the shared folder and read again. All but the last return the columns of
``documents``; the last adds ``rate`` and ``copy``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratalake.llm import decontamination, mixing, pii, quality, simhash
from stratalake.llm.tables import ready, stored, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data and disclosing words replaced in their texts."""
    return pii.sanitised(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says."""
    return mixing.mixed(docs, mixing.labelled_languages(docs, table(spark, sf_dir, "labels")), mixing.TARGETS)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("pii", personal_data_stage),
    ("mixing to target weights", mixing_stage),
]

#: Fitted models and fingerprints have no SQL form; tests hold every stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(ready(spark), docs, sf_dir), name.replace(" ", "_"))
    return docs
