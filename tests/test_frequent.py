"""Frequent values in two passes against counts of all values."""

import pytest
from pyspark.sql import functions as F

from stratalake.operators import frequent
from stratalake.operators.profiling import top_values, value_counts


def content(df):
    return sorted(map(tuple, df.select("column_name", "value", "rows").collect()), key=str)


def same(df, columns, n=5, **options):
    found = content(frequent.frequent_values(df, columns, n, **options))
    assert found == content(top_values(value_counts(df, columns), n))
    return found


def proven(df, columns, n, tracked=64, candidates=16):
    summary = frequent.summaries(df, columns, tracked, candidates)
    counts = frequent.candidate_counts(df, columns, summary)
    return {r.column_name: r for r in frequent.proofs(summary, counts, columns, n, tracked, candidates).collect()}, counts


@pytest.fixture(scope="module")
def mixed(spark):
    """20,000 rows: few values, a heavy tail, all different, values with ties, NULLs."""
    i = F.col("id")
    return spark.range(20_000, numPartitions=6).select(
        F.when(i % 10 < 6, "a").when(i % 10 < 9, "b").alias("few"),
        F.when(i % 2 == 0, "hot").when(i % 7 == 0, "warm").when(i % 11 == 0, F.lit(None)).otherwise(F.concat(F.lit("rare "), i)).alias("tail"),
        F.concat(F.lit("k"), i).alias("key"),
        (i % 40).cast("string").alias("tied"),
        (i % 3).alias("a.number"),
    )


def test_same_rows_as_counting_everything(mixed):
    found = same(mixed, mixed.columns)
    assert ("few", None, 2000) in found and ("few", "a", 12000) in found and ("tail", "hot", 10000) in found
    assert len([r for r in found if r[0] == "key"]) == 5


@pytest.mark.parametrize("tracked,candidates", [(64, 16), (16, 8), (8, 5)])
def test_small_summaries_change_the_way_only(mixed, tracked, candidates):
    same(mixed, mixed.columns, 3, tracked=tracked, candidates=candidates)


def test_proofs_are_given_where_they_hold(mixed):
    found, counts = proven(mixed, ["few", "tail", "key"], 1, tracked=1024)
    assert found["few"].proven and found["few"].uncounted == 0
    assert found["tail"].proven and 0 < found["tail"].missed < 10000
    assert not found["key"].proven
    # What is counted, and so shuffled, does not grow with the distinct values.
    assert counts.count() <= 3 * 16


def test_a_tie_with_an_uncounted_value_is_no_proof(mixed):
    found, _ = proven(mixed, ["tied"], 5, tracked=64, candidates=16)
    assert not found["tied"].proven
    assert [r[1] for r in same(mixed, ["tied"], 5, tracked=64, candidates=16)] == ["0", "1", "10", "11", "12"]


def test_heavy_values_between_many_single_ones(spark):
    """Ten values of 1% each, spread over all partitions, between 90,000 that occur once."""
    i = F.col("id")
    df = spark.range(100_000, numPartitions=8).select(F.when(i % 10 == 0, F.concat(F.lit("h"), (i / 10).cast("long") % 10)).otherwise(F.sha1(i.cast("string"))).alias("v"))
    found, _ = proven(df, ["v"], 10, tracked=12_288, candidates=64)
    assert found["v"].proven and found["v"].missed < 1000
    assert same(df, ["v"], 10) == [("v", f"h{k}", 1000) for k in range(10)]


def test_long_values_empty_tables_and_nulls_only(spark):
    long = spark.range(30).select(F.repeat(F.lit("x"), 1_000_000 + (F.col("id") % 2).cast("int")).alias("v"))
    assert [r[2] for r in same(long, ["v"])] == [15, 15]
    empty = spark.createDataFrame([], "v string, w bigint")
    assert same(empty, ["v", "w"]) == []
    assert same(spark.createDataFrame([(None,), (None,), ("",)], "v string"), ["v"], 2) == [("v", "", 1), ("v", None, 2)]


def test_senseless_sizes_are_refused(mixed):
    with pytest.raises(ValueError):
        frequent.frequent_values(mixed, ["few"], 5, candidates=4)
    with pytest.raises(ValueError):
        frequent.frequent_values(mixed, ["few"], 5, tracked=16, candidates=64)
