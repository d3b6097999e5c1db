"""Costs, runs, anomalies, text rules, neighbours."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.operators import anomalies, neighbors, opslog, tagging


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_cost_of_a_million_tokens(spark):
    df = spark.createDataFrame([(1_000_000, 1_000_000), (50, 0)], "input_tokens bigint, output_tokens bigint")
    out = [(float(r.input_cost), float(r.output_cost), float(r.total_cost)) for r in opslog.compute_cost(df).collect()]
    assert out == [(0.11, 0.34, 0.45), (6e-06, 0.0, 6e-06)]


def test_share_of_no_cost_is_zero(spark):
    df = spark.createDataFrame([("a", 0, 0)], "agent string, input_tokens bigint, output_tokens bigint")
    assert opslog.cost_share(df).first().share_pct == 0.0


RUN = "dag_id string, dag_run_id string, state string, start_date timestamp, end_date timestamp"


def runs(spark, states, minutes=None):
    start = dt.datetime(2024, 1, 1)
    rows = []
    for i, state in enumerate(states):
        begin = start + dt.timedelta(hours=10 * i)
        rows.append(("d", f"r{i:03}", state, begin, begin + dt.timedelta(minutes=(minutes or {}).get(i, 10))))
    return spark.createDataFrame(rows, RUN)


def test_streaks_cross_days_and_end_at_any_other_state(spark):
    df = runs(spark, ["failed", "failed", "failed", "failed", "running", "failed", "failed", "success", "failed", "failed", "failed"])
    assert sorted(r.failures for r in anomalies.failure_streaks(df).collect()) == [3, 4]


def test_durations_and_sla(spark):
    df = runs(spark, ["success"] * 12, minutes={5: 31, 11: 25})
    assert [r.dag_run_id for r in opslog.sla_misses(df).collect()] == ["r005"]
    assert sorted(r.dag_run_id for r in anomalies.duration_anomaly(df).collect()) == ["r005", "r011"]
    assert opslog.run_history(df, 3).count() == 3


def test_weekday_baseline_and_suppression(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(42)]
    values = [100] * 42
    values[40] = 80  # a Saturday, 20% below
    values[39] = 60  # a Friday, 40% below
    values[31] = 150  # the first of February
    df = spark.createDataFrame(list(zip(days, values)), "day date, value int")
    out = {r.day: r for r in anomalies.suppress_expected(anomalies.weekday_anomaly(df).withColumn("is_anomaly", F.abs("deviation_pct") > 15)).collect()}
    assert out[days[40]].suppressed and out[days[31]].suppressed
    assert out[days[39]].is_anomaly and not out[days[39]].suppressed
    assert out[days[0]].baseline is None


def test_loops_need_three_failures_of_one_task(spark):
    rows = [("r", "t", "failed")] * 3 + [("r", "u", "failed")] * 2 + [("s", "t", "failed"), ("s", "t", "success")]
    df = spark.createDataFrame(rows, "run_id string, task_id string, state string")
    assert content(anomalies.failure_loops(df)) == [("r", "t", 3)]


def test_connections_without_or_with_failed_jobs(spark):
    connections = spark.createDataFrame([(1, "ok"), (2, "bad"), (3, "none")], "connection_id int, name string")
    t = dt.datetime(2024, 1, 1)
    jobs = spark.createDataFrame([(1, 1, "failed", t), (2, 1, "succeeded", t + dt.timedelta(1)), (3, 2, "failed", t)], "job_id int, connection_id int, status string, started_at timestamp")
    assert {r.name: r.problem for r in opslog.sync_health(connections, jobs).collect()} == {"bad": "failed", "none": "no job history"}


def test_tally(spark):
    doc = '{"results":[{"status":"pass"},{"status":"success"},{"status":"fail"},{"status":"skipped"},{"status":"odd"}]}'
    df = spark.createDataFrame([(doc,), ("rubbish",)], "json string")
    assert tuple(opslog.tally_results(df).first()) == (2, 0, 1, 1, 4)


# ---- text


@pytest.mark.parametrize(
    "message,intent",
    [
        ("please self-heal the dag", "self_healing"),
        ("hello there", "insight"),
        ("did the DAG run fail?", "orchestration"),
        ("null rate of a column", "quality"),
        ("detect anomaly in the pipeline task dag", "anomaly"),
    ],
)
def test_intent_equals_the_scoring_rule(spark, message, intent):
    low = message.lower()
    scores = {i: sum(w in low for w in words) * tagging.INTENT_WEIGHTS.get(i, 1) for i, words in tagging.INTENT_KEYWORDS.items()}
    best = max(scores.values())
    expected = "insight" if best == 0 else next(i for i in tagging.INTENT_PRIORITY if scores[i] == best)
    row = tagging.tag_intent(spark.createDataFrame([(message,)], "content string")).first()
    assert (row.intent, row.intent_score) == (expected, best)
    assert row.intent == intent


def test_log_classes_and_last_error_line(spark):
    logs = spark.createDataFrame([("ok\nERROR one\nConnection Refused Exception: x\nbye",), ("fine",)], "log string")
    out = tagging.error_tail(tagging.classify_errors(logs), 3).collect()
    assert [(r.error_class, r.error_line, r.tail) for r in out] == [("service_down", "Connection Refused Exception: x", "bye"), ("unknown", None, "ine")]


def test_question_key_ignores_case_and_outer_blanks(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", " Hi ", t), ("a", "hi", t), ("b", "hi", t)], "agent string, content string, created_at timestamp")
    assert [r.times for r in tagging.repeat_questions(df).collect()] == [2]


# ---- neighbours


def vectors(spark, n, name, seed, dim=6):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, dim)], i % 3) for i in range(n)]
    return rows, spark.createDataFrame(rows, f"{name} bigint, embedding array<float>, label int")


def brute(queries, corpus, k, max_dist, metric="l2"):
    out = set()
    for q, qv, _ in queries:
        scored = []
        for c, cv, _ in corpus:
            a, b = np.array(qv), np.array(cv)
            d = float(((a - b) ** 2).sum()) if metric == "l2" else 1 - float(a @ b) / max(np.linalg.norm(a) * np.linalg.norm(b), 1e-300)
            scored.append((round(d, 9), c))
        out |= {(q, c) for d, c in sorted(scored)[:k] if max_dist is None or d < max_dist}
    return out


@pytest.mark.parametrize("rows", [8_192, 16])
@pytest.mark.parametrize("max_dist", [None, 12.0])
def test_neighbours_equal_brute_force(spark, monkeypatch, rows, max_dist):
    monkeypatch.setattr(neighbors, "SHARD_ROWS", rows)
    monkeypatch.setattr(neighbors, "QUERY_ROWS", 7)
    q_rows, queries = vectors(spark, 20, "query_id", 1)
    c_rows, corpus = vectors(spark, 150, "vec_id", 2)
    hits = neighbors.knn(queries.drop("label"), corpus.repartition(5), 4, max_dist).collect()
    assert {(r.query_id, r.vec_id) for r in hits} == brute(q_rows, c_rows, 4, max_dist)
    assert max(r["rank"] for r in hits) <= 4


def test_many_queries_give_the_same_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 6)]) for i in range(10_000)]
    queries = spark.createDataFrame(rows, "query_id bigint, embedding array<float>")
    _, corpus = vectors(spark, 100, "vec_id", 2)
    few = neighbors.knn(queries.filter("query_id < 20"), corpus, 3)
    assert content(neighbors.knn(queries, corpus, 3).filter("query_id < 20")) == content(few) and few.count() == 60


def test_no_corpus_gives_no_neighbours(spark):
    _, queries = vectors(spark, 3, "query_id", 1)
    _, corpus = vectors(spark, 3, "vec_id", 2)
    assert neighbors.knn(queries, corpus.filter("vec_id < 0"), 3).count() == 0


def test_category_filter_and_bad_metric(spark):
    _, queries = vectors(spark, 3, "query_id", 1)
    c_rows, corpus = vectors(spark, 60, "vec_id", 2)
    hits = neighbors.knn(queries, corpus, 5, category=2).collect()
    assert {r.vec_id % 3 for r in hits} == {2}
    with pytest.raises(ValueError):
        neighbors._distances(np.zeros((1, 2)), np.zeros((1, 2)), "manhattan")


def test_expansion_leaves_out_what_was_hit(spark):
    hits = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "query_id int, node string")
    edges = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "c")], "src string, dst string")
    assert content(neighbors.expand_neighbors(hits, edges)) == [(1, "c"), (2, "b"), (2, "c")]


def test_random_failures_match_a_simple_scan(spark):
    rng = random.Random(9)
    states = [rng.choice(["failed", "failed", "success"]) for _ in range(150)]
    expected, length = [], 0
    for state in [*states, "success"]:
        if state == "failed":
            length += 1
        else:
            expected += [length] if length >= 3 else []
            length = 0
    assert sorted(r.failures for r in anomalies.failure_streaks(runs(spark, states)).collect()) == sorted(expected)
