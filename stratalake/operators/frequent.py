"""Most frequent values of many columns in two passes, without shuffling the distinct values.

The first pass keeps one mergeable summary of frequent items per column, of fixed size, over 8-byte hashes of the values. The second
counts exactly, and by value, only the rows whose hash is among a summary's candidates. What the summary cannot have missed is
known from its error bound and from the rows left uncounted; a column for which that is no proof is counted in full.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.profiling import top_values, value_counts
from stratalake.operators.quality import unpivot_rows
from stratalake.session import scratch_path

#: Items a summary tracks at least, and those of them counted exactly.
TRACKED, CANDIDATES = 12_288, 64


def missed_share(tracked: int = TRACKED) -> float:
    """Share of the rows that a value left out of a summary's answer can have at most.

    A summary of frequent items with a map of m places errs by 3.5 / m of the rows; it fills three quarters of the map. It answers
    with items whose lower bound exceeds the error, so twice the error bounds all others.
    """
    return 2 * 3.5 * 0.75 / tracked


def _value(column: str) -> Column:
    return F.col(f"`{column}`").cast("string")


def summaries(df: DataFrame, columns: Sequence[str], tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """One row: ``total`` and, for each column by place, ``k0``, ``k1``, …: candidates as (item, count). NULL is a value."""
    hashed = df.select(*[F.xxhash64(_value(c)).alias(f"h{i}") for i, c in enumerate(columns)])
    kept = [F.expr(f"approx_top_k(h{i}, {candidates}, {tracked})").alias(f"k{i}") for i in range(len(columns))]
    return hashed.agg(F.count("*").alias("total"), *kept)


def candidate_counts(df: DataFrame, columns: Sequence[str], summary: DataFrame) -> DataFrame:
    """(column_name, value, rows) of the values whose hash is a candidate; exact."""
    hashes = summary.select(F.struct(*[F.col(f"k{i}.item").alias(f"c{i}") for i in range(len(columns))])).scalar()
    pairs = [
        F.when(F.array_contains(hashes[f"c{i}"], F.xxhash64(_value(c))), F.struct(F.lit(c).alias("column_name"), _value(c).alias("value")))
        for i, c in enumerate(columns)
    ]
    long = df.select(F.explode(F.array(*pairs)).alias("pair")).filter("pair is not null").select("pair.*")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def proofs(summary: DataFrame, counts: DataFrame, columns: Sequence[str], n: int, tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """(column_name, uncounted, missed, proven): rows without an exact count, the most that one value can have of them, and
    whether the ``n`` most frequent values are therefore among ``counts``."""
    entries = []
    for i, c in enumerate(columns):
        # A full answer may have left out items up to its last estimate.
        last = F.when(F.size(f"k{i}") >= candidates, F.array_min(F.transform(f"k{i}", lambda k: k["count"]))).otherwise(0)
        entries.append({"column_name": F.lit(c), "total": F.col("total"), "left_out": F.greatest(F.ceil(F.col("total") * missed_share(tracked)), last)})
    counted = counts.groupBy("column_name").agg(F.sum("rows").alias("counted"))
    least = top_values(counts, n).groupBy("column_name").agg(F.min("rows").alias("least"), F.count("*").alias("found"))
    uncounted = F.col("total") - F.coalesce("counted", F.lit(0))
    whole = unpivot_rows(summary, entries).join(counted, "column_name", "left").join(least, "column_name", "left").withColumn("uncounted", uncounted)
    missed = F.least("uncounted", "left_out")
    proven = (F.col("uncounted") == 0) | F.coalesce((F.col("found") == n) & (F.col("least") > missed), F.lit(False))
    return whole.select("column_name", "uncounted", missed.alias("missed"), proven.alias("proven"))


def frequent_values(df: DataFrame, columns: Sequence[str], n: int = 5, tracked: int = TRACKED, candidates: int = CANDIDATES) -> DataFrame:
    """(column_name, value, rows): the ``n`` most frequent values per column, equal counts in value order, NULL first.

    The same rows as ``top_values(value_counts(df, columns), n)``. The first two passes shuffle at most a summary, and ``candidates``
    values, per column and task. Columns without proof, such as keys whose values all occur once, are counted in full by a third.
    An empty table gives no rows. Values of any length: summaries hold hashes, and values with one hash are counted apart.
    """
    if not 0 < n <= candidates <= tracked:
        raise ValueError("0 < n <= candidates <= tracked")
    spark, root = df.sparkSession, scratch_path(df.sparkSession, "frequent")
    summaries(df, columns, tracked, candidates).write.parquet(f"{root}/summary")
    summary = spark.read.parquet(f"{root}/summary")
    candidate_counts(df, columns, summary).write.parquet(f"{root}/counts")
    counts = spark.read.schema("column_name string, value string, rows bigint").parquet(f"{root}/counts")
    # As many names as there are columns at most.
    unproven = proofs(summary, counts, columns, n, tracked, candidates).filter("not proven").agg(F.collect_list("column_name")).first()[0]
    top = top_values(counts.filter(~F.col("column_name").isin(unproven)), n)
    if not unproven:
        return top
    return top.unionByName(top_values(value_counts(df, unproven), n))
