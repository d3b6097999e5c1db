from stratalake.operators import history
from stratalake.session import scratch_path


def test_a_run_sees_the_stored_run_before_it(spark, rows):
    path = scratch_path(spark, "history")
    counts = lambda n: spark.createDataFrame([("p", "t", n)], "pipeline string, table_name string, row_count bigint")
    for day, n in (("2024-01-01", 100), ("2024-01-03", 70), ("2024-01-02", 200)):  # the second day arrives late
        history.observe_run(counts(n), path, day)
    stored = lambda: rows(history.read_history(spark, path, history.OBSERVED), "run_date", "row_count", "prev_count", "status")
    assert [(str(d), *r) for d, *r in stored()] == [("2024-01-01", 100, 100, "ok"), ("2024-01-02", 200, 100, "ok"), ("2024-01-03", 70, 100, "anomaly")]
    history.observe_run(counts(70), path, "2024-01-03")  # delivered again: replaced, and compared with the day that came late
    assert [(str(d), *r) for d, *r in stored()][-1] == ("2024-01-03", 70, 200, "anomaly") and len(stored()) == 3
    newest = history.latest_runs(history.read_history(spark, path, history.OBSERVED), 2)
    assert {str(r.run_date) for r in newest.collect()} == {"2024-01-02", "2024-01-03"}


def test_an_empty_history_is_kept(spark):
    path = scratch_path(spark, "history")
    history.start_history(spark, path, "n int")
    history.append_run(spark.range(2).selectExpr("cast(id as int) n"), path, "2024-01-01")
    history.start_history(spark, path, "n int")
    assert history.read_history(spark, path, "n int").count() == 2
