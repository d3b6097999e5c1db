import pytest
from pyspark.sql import functions as F

from stratalake.streaming import sketches


@pytest.fixture(scope="module")
def events(spark):
    """Days with many users, one day missing, one user without an id."""
    many = spark.range(60_000).select((F.col("id") % 41_000).alias("user_id"), F.expr("timestamp'2024-01-01' + make_dt_interval(cast(id % 12 + if(id % 12 > 6, 2, 0) as int))").alias("occurred_at"))
    return many.unionByName(spark.sql("select cast(null as bigint) user_id, timestamp'2024-01-03' occurred_at"))


def test_rolling_estimates_are_near_the_exact_counts(events):
    days = sketches.streaming_day_sketches(events)
    for length in (1, 7, 28):
        exact = {r.event_date: r.exact for r in sketches.exact_rolling_actives(events, length).collect()}
        found = {r.event_date: r.actives for r in sketches.rolling_actives(days, length).collect()}
        assert set(found) == set(exact) and len(exact) == 12
        assert all(abs(found[d] - n) <= 0.03 * n for d, n in exact.items())


def test_a_sketch_does_not_grow_with_its_users(spark):
    size = lambda n: sketches.streaming_day_sketches(spark.range(n).selectExpr("id user_id", "timestamp'2024-01-01' occurred_at")).select(F.length("users")).first()[0]
    assert size(400_000) <= size(100_000) * 1.1 and size(400_000) < 20_000


def test_reading_sketches_needs_no_events(events, tmp_path):
    sketches.streaming_day_sketches(events).write.parquet(str(tmp_path / "days"))
    days = events.sparkSession.read.parquet(str(tmp_path / "days"))
    plan = sketches.rolling_actives(days, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "user_id" not in plan
