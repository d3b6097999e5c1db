"""The bounded, reproducible sample of labelled documents that classifiers are fitted on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows a classifier is fitted on at most: those whose id hashes lowest.
MAX_LABELLED = 20_000


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for ids kept out of learning; documents without an id are never labelled and never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, doc_id: str, text: str, rows: int = MAX_LABELLED) -> DataFrame:
    """``(id, text, label)`` of labelled documents that are not held out, for at most ``rows`` label rows.

    The label rows are cut before the texts are read; they are few by that bound and go to every task.
    """
    usable = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    chosen = usable.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id", "label").limit(rows)
    return docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
