"""Quality checks, profiles, contracts, governance."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stratalake.operators import contracts, governance, integrity, profiling, quality
from stratalake.plans import suites

DAY = dt.date(2024, 1, 10)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def people(spark):
    rows = [(1, "a", 5.0), (2, "b", None), (2, "c", 50.0), (None, None, 7.0)]
    return spark.createDataFrame(rows, "id bigint, kind string, score double")


def success(df, *rules):
    suite = suites.suite("s", *rules)
    return [r.success for r in quality.validate(df, suite).orderBy("position").collect()]


def test_rules_skip_nulls_but_not_null_sees_them(people):
    assert success(people, suites.not_null("id", "score")) == [False, False]
    assert success(people, suites.in_set("kind", ["a", "b", "c"])) == [True]
    assert success(people, suites.between("score", 5, 50), suites.between("score", 6), suites.between("score", None, 49)) == [True, False, False]
    assert success(people, suites.unique("kind"), suites.unique("id")) == [True, False]
    assert success(people, suites.unique_share("id", 0.6), suites.unique_share("id", 0.7)) == [True, False]
    assert success(people, suites.row_count(4, 4), suites.row_count(5), suites.exists("id", "gone"), suites.not_null("gone")) == [True, False, True, False, False]


def test_unknown_rules_are_refused(people):
    with pytest.raises(ValueError):
        quality.validate(people, suites.suite("s", [{"expectation_type": "expect_magic", "kwargs": {"column": "id"}}]))


def test_checkpoint_sums_up(people):
    good, bad = suites.suite("good", suites.row_count(1)), suites.suite("bad", suites.row_count(1), suites.not_null("id"))
    out = {r.suite: (r.evaluated, r.failed, r.success) for r in quality.run_checkpoint([(people, good), (people, bad)]).collect()}
    assert out == {"good": (1, 0, True), "bad": (2, 1, False)}


def test_schema_tests_count_violating_rows(spark, people):
    parents = spark.createDataFrame([(1,)], "id bigint")
    declared = {"people": {"id": ["unique", "not_null", {"relationships": ("parents", "id")}], "kind": [{"accepted_values": ["a"]}]}}
    out = {(r.column_name, r.test): r.failures for r in quality.run_schema_tests({"people": people, "parents": parents}, declared).collect()}
    assert out == {("id", "unique"): 1, ("id", "not_null"): 1, ("id", "relationships"): 2, ("kind", "accepted_values"): 2}


@pytest.mark.parametrize("count,status,delta", [(74, "anomaly", -26.0), (75, "ok", -25.0), (130, "ok", 30.0)])
def test_drop_of_more_than_a_quarter_is_an_anomaly(spark, count, status, delta):
    history = spark.createDataFrame([(DAY, "p", "t", 100), (DAY - dt.timedelta(5), "p", "t", 7)], "run_date date, pipeline string, table_name string, row_count bigint")
    current = spark.createDataFrame([("p", "t", count), ("p", "new", 5)], "pipeline string, table_name string, row_count bigint")
    out = {r.table_name: r for r in quality.observability(history, current, "2024-01-11").collect()}
    assert (out["t"].status, out["t"].delta_pct) == (status, delta)
    assert (out["new"].prev_count, out["new"].status) == (5, "ok")


def test_null_keys_are_orphans_only_when_asked(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k bigint")
    parent = spark.createDataFrame([(1,)], "k bigint")
    assert integrity.orphans(child, parent, "k").first().orphans == 3
    assert integrity.orphans(child, parent, "k", null_is_orphan=False).first().orphans == 2
    assert content(integrity.fk_violations(child, parent, "k")) == [(2, 2)]
    for exists_form in (False, True):
        refs = [integrity.Reference("r", child, parent, "k")]
        assert content(integrity.referential_integrity(refs, exists_form)) == [("r", 3, False)]


def test_null_rates_of_an_empty_table_give_no_row(spark, people):
    out = quality.null_rates({"people": (people, ["id"]), "none": (people.limit(0), ["id"])}).collect()
    assert [(r.table_name, r.null_rate, r.ok) for r in out] == [("people", 0.25, False)]
    blank = spark.createDataFrame([("",), ("x",)], "c string")
    assert quality.null_rates({"t": (blank, ["c"])}).first().null_rate == 0.0
    assert quality.null_rates({"t": (blank, ["c"])}, blank_is_null=True).first().null_rate == 0.5


def test_null_keys_count_as_duplicates(people):
    assert tuple(quality.duplicate_count(people, "id").first()) == (4, 2, 2)


@pytest.mark.parametrize("hours,status", [(24, "pass"), (26, "warn"), (50, "error")])
def test_freshness(spark, hours, status):
    moment = dt.datetime(2024, 1, 10) - dt.timedelta(hours=hours)
    df = spark.createDataFrame([(moment,)], "ts timestamp")
    out = {r.table_name: r.status for r in quality.freshness({"t": (df, "ts", 25, 49), "none": (df.limit(0), "ts", 25, 49)}, "2024-01-10").collect()}
    assert out == {"t": status, "none": "error"}


@pytest.mark.parametrize(
    "rows,score,band",
    [
        ([("row_count", 100.0, 100.0)], 100, "HEALTHY"),
        ([("row_count", 49.0, 100.0), ("null_rate", 0.5, None)], 70, "WARNING"),
        ([("duplicates", 1.0, None), ("orphans", 1.0, None)], 55, "CRITICAL"),
        ([("duplicates", 1.0, None)] * 4, 0, "CRITICAL"),
        ([("stale", 3.0, None)], 90, "HEALTHY"),
    ],
)
def test_health_score(spark, rows, score, band):
    df = spark.createDataFrame([(k, "n", v, e) for k, v, e in rows], "kind string, name string, value double, expected double")
    assert tuple(quality.health_score(df).first()) == (score, band)


def test_assertions_return_the_violating_rows(spark):
    fact = spark.createDataFrame([(1, "completed", 5, 0), (2, "pending", 5, 0)], "order_id int, status string, amount int, revenue int")
    assert [r.order_id for r in quality.assert_revenue_consistency(fact).collect()] == [1]
    assert quality.assert_positive(fact, "amount", "order_id").isEmpty()
    assert quality.assert_non_negative(fact, "revenue", "order_id").isEmpty()
    assert content(quality.assert_non_empty({"full": fact, "empty": fact.limit(0)})) == [("empty", False), ("full", True)]


# ---- profiles and contracts


def test_profile_of_numbers_texts_and_nothing(spark, people):
    out = {r.column_name: r for r in profiling.profile(people, "people").collect()}
    assert (out["id"].null_count, out["id"].null_rate, out["id"].min_val, out["id"].max_val) == (1, 0.25, 1.0, 2.0)
    assert (out["kind"].distinct_count, out["kind"].top5_values, out["kind"].min_val) == (4, "NULL | a | b | c", None)
    empty = profiling.profile(people.limit(0), "none").collect()
    assert [(r.column_name, r.row_count) for r in empty] == [("_empty_", 0)]


def test_sketches_are_close_to_the_truth(spark):
    df = spark.range(20000).select(F.col("id").alias("n"), (F.col("id") % 500).cast("string").alias("t"))
    out = {r.column_name: r for r in profiling.profile_stats(df).collect()}
    assert abs(out["n"].p5 - 1000) < 20 and abs(out["n"].p95 - 19000) < 20
    assert abs(out["n"].cardinality - 20000) < 2000 and abs(out["t"].cardinality - 500) < 50
    assert out["t"].top_values is None


def test_unreadable_sources_are_listed(spark):
    out = profiling.profile_sources(spark, {"gone": "/tmp/no-such-folder-here"}).collect()
    assert [(r.source, r.column_name) for r in out] == [("gone", "_error_")] and "PATH_NOT_FOUND" in out[0].error


def test_unreadable_files_are_listed_beside_readable_ones(spark, tmp_path):
    spark.range(3).select(F.col("id"), F.lit("x").alias("t")).write.parquet(f"{tmp_path}/good")
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"PAR1 no table PAR1")
    # Its footer is whole, so it fails only when it is scanned.
    spark.range(5000).coalesce(1).write.parquet(f"{tmp_path}/late")
    late = next((tmp_path / "late").glob("part-*.parquet"))
    data = late.read_bytes()
    late.write_bytes(data[:4] + b"\xff" * 200 + data[204:])
    for crc in (tmp_path / "late").glob(".*.crc"):
        crc.write_bytes(b"")
    report = profiling.profile_sources(spark, {n: f"{tmp_path}/{n}" for n in ("bad", "good", "late")}).collect()
    assert sorted((r.source, r.column_name) for r in report) == [("bad", "_error_"), ("good", "id"), ("good", "t"), ("late", "_error_")]
    assert all(r.error for r in report if r.column_name == "_error_")


def test_contract_bounds(spark):
    df = spark.range(1000).select(F.col("id").alias("order_id"), F.lit("x").alias("kind"))
    rules = {(r.expectation_type, r.column): (r.min_value, r.max_value) for r in contracts.generate_contract(df, {"order_id"}).collect()}
    assert rules[(contracts.ROW_COUNT, None)] == (900.0, 1200.0)
    assert rules[(contracts.BETWEEN, "order_id")] == (0.0, 999.0)
    assert (contracts.NOT_NULL, "kind") not in rules and (contracts.UNIQUE, "order_id") in rules
    stat = {(r.expectation_type, r.column): r for r in contracts.generate_stat_contract(df).collect()}
    assert (stat[(contracts.ROW_COUNT, None)].min_value, stat[(contracts.ROW_COUNT, None)].max_value) == (500.0, 2000.0)
    assert stat[(contracts.IN_SET, "kind")].value_set == "x"


def test_contract_documents_are_checked(spark):
    docs = ['[{"expectation_type":"e","kwargs":{"column":"c"}}]', '[{"kwargs":{}}]', '{"a":1}', "nonsense", "[]"]
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(docs)], "name string, json string")
    assert {r.name: r.valid for r in contracts.validate_contract(df).collect()} == {"0": True, "1": False, "2": False, "3": False, "4": True}


# ---- governance


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        (1, "SELECT user_id FROM gold.t", "QueryFinish", "Select", dt.datetime(2024, 1, 10, 1)),
        (2, "select ID from GOLD.t", "QueryFinish", "Select", dt.datetime(2024, 1, 10, 2)),
        (3, "SELECT id FROM raw.t", "QueryFinish", "Select", dt.datetime(2024, 1, 10, 3)),
        (4, "SELECT id FROM gold.t", "QueryFinish", "Select", dt.datetime(2024, 1, 8)),
        (5, "DROP  TABLE gold.t", "QueryFinish", "Drop", dt.datetime(2024, 1, 10, 3)),
        (6, "SELECT created_at FROM gold.fct_orders JOIN staging.stg_users USING (x) -- gold.fct_orders", "QueryFinish", "Select", dt.datetime(2024, 1, 10, 4)),
    ]
    return spark.createDataFrame(rows, "query_id int, query string, type string, query_kind string, event_time timestamp")


CATALOG = [("gold", "t", "id"), ("gold", "t", "user_id"), ("gold", "t", "x"), ("gold", "u", "never")]


def usage(spark, log, **options):
    catalog = spark.createDataFrame(CATALOG, "schema_name string, table_name string, column_name string")
    return {r.column_name: r.query_count_24h for r in governance.column_usage(log, catalog, "2024-01-10 12:00:00", **options).collect()}


def test_usage_matches_substrings_unless_whole_words_are_asked_for(spark, log):
    assert usage(spark, log) == {"id": 2, "user_id": 1, "x": 1, "never": 0}
    assert usage(spark, log, whole_word=True) == {"id": 1, "user_id": 1, "x": 1, "never": 0}


def test_many_names_give_the_same_counts(spark, log):
    expected = usage(spark, log)
    many = [*CATALOG, *[("gold", "v", f"other_{i}_column") for i in range(20_000)], ("gold", "v", "from gold.")]
    catalog = spark.createDataFrame(many, "schema_name string, table_name string, column_name string")
    found = governance.column_usage(log, catalog, "2024-01-10 12:00:00")
    got = {r.column_name: r.query_count_24h for r in found.filter("table_name <> 'v' or column_name = 'from gold.'").collect()}
    text = got.pop("from gold.")
    assert got == expected and text == log_texts(spark, log)


def log_texts(spark, log):
    return sum("from gold." in r.query.lower() for r in governance.finished_selects(log, "2024-01-10 12:00:00").collect())


def test_unsafe_statements_and_references(log):
    assert [r.query_id for r in governance.flag_unsafe_sql(log).filter("is_unsafe").collect()] == [5]
    assert content(governance.table_refs(log)) == [(6, "fct_orders"), (6, "stg_users")]


def test_schema_evolution_keeps_removed_columns_in_the_snapshot(spark):
    schema = "table_name string, column_name string"
    now = spark.createDataFrame([("t", "a"), ("t", "b")], schema)
    then = spark.createDataFrame([("t", "a"), ("t", "gone")], schema)
    evolution = governance.schema_evolution(now, then)
    assert content(evolution) == [("t", "b", "added"), ("t", "gone", "removed")]
    assert content(governance.next_snapshot(now, then)) == [("t", "a"), ("t", "b"), ("t", "gone")]
    assert [r.column_name for r in governance.drift_alerts(evolution, "src", "2024-01-01").collect()] == ["gone"]
    assert content(governance.schema_drift(then, now)) == [("t", "b", "gone")]


def test_exact_stats_of_many_values(spark):
    """More rows than a sketch keeps apart, frequent values at a percentile, nulls, negative numbers, a column without values."""
    number = F.when(F.col("id") % 7 == 0, None).otherwise((F.col("id") * 7919) % 60013 - 30000)
    df = spark.range(60000).select(
        number.alias("n"), F.when(F.col("id") < 6000, 1).otherwise(F.col("id")).alias("few"), F.lit(None).cast("double").alias("none"),
        (F.col("id") % 30000).cast("string").alias("t"), (F.col("id") % 3).cast("string").alias("u"),
    )
    out = {r.column_name: r for r in profiling.profile_stats(df, exact=True).collect()}
    values = sorted(i * 7919 % 60013 - 30000 for i in range(60000) if i % 7)
    at = lambda share: float(values[math.ceil(share * len(values)) - 1])
    assert (out["n"].cardinality, out["n"].p5, out["n"].p95) == (len(set(values)), at(0.05), at(0.95))
    assert (out["few"].cardinality, out["few"].p5, out["few"].p95) == (54001, 1.0, 56999.0)
    assert (out["none"].cardinality, out["none"].p5, out["none"].null_pct) == (0, None, 100.0)
    assert (out["t"].cardinality, out["t"].top_values, out["u"].cardinality, out["u"].top_values) == (30000, None, 3, "0 | 1 | 2")
    empty = profiling.profile_stats(df.limit(0), exact=True).collect()
    assert {(r.row_count, r.cardinality, r.p5) for r in empty} == {(0, 0, None)}


def test_exact_stats_keep_sketches_out_of_groups(spark):
    """Percentiles are found apart from the distinct values, so no group of values carries a sketch."""
    df = spark.range(10).select("id", F.col("id").cast("string").alias("t"))
    text = profiling.profile_stats(df, exact=True)._jdf.queryExecution().executedPlan().toString()
    assert "gid" not in text and "1000000" not in text
