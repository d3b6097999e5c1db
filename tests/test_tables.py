"""Incremental and versioned tables, sinks, landing."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake.operators import incremental as inc
from stratalake.operators import scd
from stratalake.operators.dedup import collapse_versions, dedup_latest, last_n
from stratalake.operators.neighbour_rows import last_seen, next_values, previous_values
from stratalake.session import scratch_path
from stratalake.sources import files, jdbc, landing, sinks

SCHEMA = "id bigint, value string, ts timestamp"


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


# ---- incremental


def test_first_run_loads_everything(spark):
    source = spark.createDataFrame([(1, "a", at(1)), (2, "b", at(2))], SCHEMA)
    assert content(inc.incremental_upsert(source.limit(0), source, ["id"], "ts")) == content(source)


def test_lookback_replaces_and_misses_as_designed(spark):
    target = spark.createDataFrame([(1, "old", at(10)), (2, "old", at(8)), (3, "old", at(9, 30))], SCHEMA)
    source = spark.createDataFrame([(1, "new", at(10)), (2, "late", at(8, 30)), (3, "new", at(9, 30)), (4, "new", at(11))], SCHEMA)
    out = {r.id: r.value for r in inc.incremental_upsert(target, source, ["id"], "ts").collect()}
    assert out == {1: "new", 2: "old", 3: "new", 4: "new"}
    again = {r.id: r.value for r in inc.incremental_upsert(target, source, ["id"], "ts", full_refresh=True).collect()}
    assert again == {1: "new", 2: "late", 3: "new", 4: "new"}


def test_strict_lookback_excludes_the_bound(spark):
    target = spark.createDataFrame([(1, "old", at(10, 20))], SCHEMA)
    source = spark.createDataFrame([(2, "bound", at(9, 20)), (3, "after", at(9, 21))], SCHEMA)
    ids = lambda **o: sorted(r.id for r in inc.new_rows(source, target, "ts", **o).collect())
    assert ids(floor=None) == [2, 3]
    assert ids(floor=None, strict=True) == [3]
    assert ids() == [2, 3]


def test_running_twice_equals_running_once(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(20), f"v{i}", at(rng.randrange(24), rng.randrange(60), rng.randrange(1, 5))) for i in range(60)]
    source = dedup_latest(spark.createDataFrame(rows, SCHEMA), ["id"], ["ts", "value"])
    target = spark.createDataFrame([(1, "old", at(0))], SCHEMA)
    once = spark.createDataFrame(inc.incremental_upsert(target, source, ["id"], "ts").collect(), SCHEMA)
    assert content(inc.incremental_upsert(once, source, ["id"], "ts")) == content(once)


def test_append_by_append_equals_full_refresh(spark):
    rows = [(i % 7, f"v{i}", at(i // 4, 10 * (i % 4))) for i in range(40)]
    target = spark.createDataFrame([], SCHEMA)
    for end in (10, 20, 30, 40):
        seen = spark.createDataFrame(rows[:end], SCHEMA)
        result = inc.incremental_upsert(target, seen, ["id"], "ts", dedupe=["ts"])
        target = spark.createDataFrame(result.collect(), SCHEMA)
    assert content(target) == content(dedup_latest(spark.createDataFrame(rows, SCHEMA), ["id"], ["ts"]))


def test_change_rows_update_insert_and_delete(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, value string")
    changes = spark.createDataFrame(
        [(1, "a2", at(1), None), (1, "a3", at(2), ""), (2, "b2", at(1), None), (2, "b3", at(3), "2024-01-01"), (3, "c", at(1), None)],
        "id bigint, value string, ts timestamp, deleted string",
    )
    assert content(inc.apply_cdc(target, changes, ["id"], ["ts"], "deleted")) == [(1, "a3"), (3, "c")]


def test_late_older_images_change_nothing(spark):
    target = spark.createDataFrame([(1, "may", at(5)), (2, "may", at(5)), (3, "may", at(5))], SCHEMA)
    late = [(1, "january", at(1), None), (2, "again", at(5), None), (3, "gone", at(1), "x"), (4, "new", at(1), None)]
    out = inc.apply_cdc(target, spark.createDataFrame(late, SCHEMA + ", deleted string"), ["id"], ["ts"], "deleted")
    assert content(out.select("id", "value")) == [(1, "may"), (2, "again"), (3, "may"), (4, "new")]


def test_replace_day_is_idempotent(spark):
    schema = "day date, n bigint"
    days = [dt.date(2024, 1, d) for d in (1, 2)]
    target = spark.createDataFrame([(days[0], 1), (days[1], 1)], schema)
    fresh = spark.createDataFrame([(days[1], 5)], schema)
    once = inc.replace_day(target, fresh, "day", "2024-01-02")
    assert content(inc.replace_day(once, fresh, "day", "2024-01-02")) == content(once) == [(days[0], 1), (days[1], 5)]


def test_retention_keeps_young_rows(spark):
    df = spark.createDataFrame([(1, "x", at(0, day=1)), (2, "x", at(0, day=9))], SCHEMA)
    assert [r.id for r in inc.apply_retention(df, "ts", 5, "2024-01-10").collect()] == [2]


def test_versions_and_last_rows(spark):
    df = spark.createDataFrame([(1, "a", at(1)), (1, "b", at(2)), (2, "c", at(1))], SCHEMA)
    assert content(collapse_versions(df, ["id"], "ts").select("id", "value")) == [(1, "b"), (2, "c")]
    assert [r.value for r in last_n(df.filter("id = 1"), ["id"], ["ts"], 5).collect()] == ["a", "b"]


# ---- neighbouring rows


def hot_rows(seed=1, n=400):
    """One key holds most of the rows; many rows share a bucket and some buckets are empty."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rng.random() < 0.7 else rng.randrange(1, 6)
        out.append((key, i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.choice([1, 2, 30, 31, 200]) + i // 50), rng.choice("ab")))
    return out


@pytest.mark.parametrize("null_key", [None, 0], ids=["hot key", "hot NULL key"])
@pytest.mark.parametrize("unit", ["day", "week", "year"])
def test_bucketed_neighbours_equal_plain_windows(spark, unit, null_key):
    from pyspark.sql import Window

    df = spark.createDataFrame(hot_rows(), "key int, seq int, ts timestamp, state string")
    df = df.withColumn("key", F.nullif("key", F.lit(null_key).cast("int")))
    plain = Window.partitionBy("key").orderBy("ts", "seq")
    day = F.to_date(F.date_trunc(unit, "ts"))
    before = previous_values(df, ["key"], ["ts", "seq"], {"p": "seq", "ps": "state"}, day)
    after = next_values(df, ["key"], ["ts", "seq"], {"n": "seq"}, day)
    expected = df.withColumns({"p": F.lag("seq").over(plain), "ps": F.lag("state").over(plain)})
    assert content(before.select("seq", "p", "ps")) == content(expected.select("seq", "p", "ps"))
    assert content(after.select("seq", "n")) == content(df.withColumn("n", F.lead("seq").over(plain)).select("seq", "n"))
    fine = F.when(F.col("state") == "a", F.col("ts"))
    seen = last_seen(df, ["key"], ["ts", "seq"], fine, "fine", day)
    frame = plain.rowsBetween(Window.unboundedPreceding, -1)
    assert content(seen.select("seq", "fine")) == content(df.withColumn("fine", F.max(fine).over(frame)).select("seq", "fine"))


# ---- slowly changing dimensions

TRACKED = ["email", "segment"]
CHANGE = "id bigint, email string, segment string, updated_at timestamp, lsn bigint"


def changes(spark, n=200):
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.choice(["x", "y"]), "VIP", at(0) + dt.timedelta(days=i // 3, hours=i % 3), i) for i in range(n)]
    return spark.createDataFrame(rows, CHANGE)


def test_history_intervals_are_gapless_and_have_one_current(spark):
    dim = scd.scd2_history(changes(spark), "id", TRACKED, "updated_at", "lsn").collect()
    by_key = {}
    for r in dim:
        by_key.setdefault(r.id, []).append(r)
    for versions in by_key.values():
        versions.sort(key=lambda r: r.valid_from)
        assert [v.is_current for v in versions] == [0] * (len(versions) - 1) + [1]
        for a, b in zip(versions, versions[1:]):
            assert a.valid_to == b.valid_from and (a.email, a.segment) != (b.email, b.segment)


def test_merging_a_batch_twice_changes_nothing(spark):
    all_rows = changes(spark)
    split = at(0) + dt.timedelta(days=40)
    dim = scd.scd2_history(all_rows.filter(F.col("updated_at") < split), "id", TRACKED, "updated_at", "lsn")
    batch = all_rows.filter(F.col("updated_at") >= split)
    once = scd.scd2_merge(dim, batch, "id", TRACKED)
    stored = spark.createDataFrame(once.collect(), once.schema)
    assert content(scd.scd2_merge(stored, batch, "id", TRACKED)) == content(stored)
    assert stored.filter("is_current = 1").count() == stored.select("id").distinct().count()


def test_merge_ignores_older_images_and_adds_new_keys(spark):
    first = spark.createDataFrame([(1, "x", "VIP", at(10), 1)], CHANGE)
    dim = scd.scd2_history(first, "id", TRACKED, "updated_at", "lsn")
    batch = spark.createDataFrame([(1, "old", "VIP", at(9), 2), (2, "n", "B2B", at(11), 3)], CHANGE)
    out = scd.scd2_merge(dim, batch, "id", TRACKED)
    assert sorted((r.id, r.email, r.is_current) for r in out.collect()) == [(1, "x", 1), (2, "n", 1)]


# ---- sinks and landing


def test_tsv_cells(spark):
    df = spark.createDataFrame(
        [(1, None, "a\tb\nc", dt.datetime(2024, 1, 2, 3, 4, 5, 678), Decimal("29.00")), (2, "x", "y", None, Decimal("12345678.50"))],
        "id int, none string, text string, ts timestamp, amount decimal(18,2)",
    )
    assert [r.line for r in sinks.tsv_lines(df).orderBy("line").collect()] == [
        "1\t\\N\ta b c\t2024-01-02 03:04:05\t29.0",
        "2\tx\ty\t\\N\t12345678.5",
    ]
    assert sinks.tsv_lines(df.limit(0)).count() == 0


def test_clustered_table_prunes_partitions_and_sorts_files(spark):
    path = scratch_path(spark, "clustered")
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("part"))
    sinks.write_clustered(df, path, ["id"], "part")
    back = spark.read.parquet(path)
    assert back.count() == 1000
    assert "PartitionFilters: [isnotnull(part" in back.filter("part = 1")._jdf.queryExecution().toString()


def test_appending_a_run_twice_keeps_one_copy(spark):
    path = scratch_path(spark, "runs")
    for epoch in (1, 2, 2):
        sinks.land_append(spark.range(5), path, epoch)
    assert spark.read.parquet(path).count() == 10


def test_missing_sources_are_reported(spark):
    listing = spark.createDataFrame([("a", 10, at(5)), ("a", 20, at(6))], "prefix string, length bigint, modificationTime timestamp")
    out = {r.prefix: (r.files, r.present) for r in files.require_sources(listing, ["a", "b"]).collect()}
    assert out == {"a": (2, True), "b": (0, False)}


@pytest.mark.parametrize("as_of,status", [("2024-01-02 06:00:00", "OK"), ("2024-01-02 07:00:00", "WARN"), ("2024-01-03 06:00:00", "WARN"), ("2024-01-03 06:01:00", "MISSING")])
def test_inventory_bands(spark, as_of, status):
    listing = spark.createDataFrame([("a", 10, at(5)), ("a", 20, at(6))], "prefix string, length bigint, modificationTime timestamp")
    row = files.file_inventory(listing, as_of).first()
    assert (row.files, row.bytes, row.status) == (2, 30, status)


def test_null_defaults_and_nested_columns(spark):
    df = spark.createDataFrame([(1, None, None, (1, "x"))], "id int, name string, ts timestamp, nested struct<a:int,b:string>")
    filled = landing.null_defaults(df, {"name": "", "ts": "1970-01-01 00:00:00"}).first()
    assert filled.name == "" and filled.ts == dt.datetime(1970, 1, 1)
    assert landing.flatten_nested(df).first().nested == '{"a":1,"b":"x"}'


def test_jdbc_reads_are_split_by_bounds():
    source = jdbc.JdbcSource("jdbc:x", "org.x.Driver", {"user": "u"})
    options = source.options("saas_users", jdbc.Bounds("id", 0, 1000, 8))
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["fetchsize"] == "10000"
    assert "partitionColumn" not in source.options("(SELECT 1) t")


def test_inventory_has_every_table_and_empty_files(spark, tmp_path):
    from types import SimpleNamespace

    from stratalake.queries import flows

    spark.range(5).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(0).coalesce(1).write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    t = SimpleNamespace(spark=spark, dir=str(tmp_path))
    assert sorted((r.prefix, r.rows) for r in flows.table_files(t).collect()) == [("orders", 0), ("orders", 5), ("pages", 3)]
    assert sorted((r.prefix, r.files, r.rows) for r in flows._src18(t).collect()) == [("orders", 2, 5), ("pages", 1, 3)]
