import random

import pytest
from pyspark.sql import functions as F

from stratalake.operators import neighbors, vector_index
from stratalake.operators.vector_index import build_index, recall, search

SCHEMA = "vec_id bigint, embedding array<float>"


def content(df):
    return sorted((r.query_id, r.vec_id, round(r.distance, 9), r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(12)]
    rows = []
    for i in range(900):
        c = centres[0] if i % 3 == 0 else rng.choice(centres)  # one cell holds a third and more
        rows.append((i, [x + rng.gauss(0, 0.2) for x in c]))
    rows += [(1000 + i, rows[6][1]) for i in range(7)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def queries(corpus):
    return corpus.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@pytest.mark.parametrize("k, max_dist", [(5, None), (12, 0.3), (1, 0.05)])
def test_exact_search_is_brute_force(corpus, queries, monkeypatch, k, max_dist):
    monkeypatch.setattr(vector_index, "SHARD_ROWS", 50)
    index = build_index(corpus, cells=20)
    expected = content(neighbors.knn(queries, corpus, k, max_dist))
    assert content(search(index, queries, k, max_dist, probes=1, exact=True)) == expected
    assert content(search(index, queries, k, max_dist, probes=20)) == expected


def test_every_row_is_indexed_and_bounded_by_its_cell(corpus):
    index = build_index(corpus, cells=9)
    assert index.rows.count() == corpus.count() == index.cells.agg(F.sum("members")).first()[0]
    assert index.rows.join(index.cells, "cell").filter("gap > radius").count() == 0


def test_fitted_on_a_bounded_sample(corpus):
    assert vector_index.fit_centers(corpus, cells=5, sample=40).shape == (5, 6)


def test_recall_of_the_given_vectors(spark):
    corpus = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = corpus.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    measured = recall(search(build_index(corpus), queries, 10), neighbors.knn(queries, corpus, 10)).first()
    assert (measured.queries, measured.expected) == (40, 400) and measured.recall >= 0.9


def test_few_rows_and_none(spark, queries):
    empty = spark.createDataFrame([], SCHEMA)
    assert search(build_index(empty), queries, 3).count() == 0
    one = spark.createDataFrame([(1, [0.0] * 6), (2, None), (None, [1.0] * 6)], SCHEMA)
    assert {(r.vec_id, r["rank"]) for r in search(build_index(one), queries, 3, exact=True).collect()} == {(1, 1)}
    assert search(build_index(one), queries.limit(0), 3).count() == 0
    assert recall(search(build_index(empty), queries, 3), neighbors.knn(queries, empty, 3)).first().recall is None


def test_no_distances_between_centres_reach_the_driver(spark, corpus):
    """Fitting never runs the pass over all pairs of centres, whose result grows with the square of the cells."""
    tracker, before = spark.sparkContext.statusTracker(), None
    spark.sparkContext.setJobGroup("fit-centers", "fit")
    try:
        centers = vector_index.fit_centers(corpus, cells=450)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", before)
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("fit-centers") for s in tracker.getJobInfo(j).stageIds]
    assert len(centers) > 400 and stages
    assert not [s.name for s in stages if s and "DistanceMeasure" in s.name]
