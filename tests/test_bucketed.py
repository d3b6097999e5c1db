import glob
import pathlib

import pytest

from stratalake.operators.incremental import apply_cdc, delete_insert
from stratalake.session import scratch_path
from stratalake.sources import bucketed

KEYS = ["id"]


@pytest.fixture
def table(spark):
    path = scratch_path(spark, "bucketed")
    rows = spark.range(400).selectExpr("id", "id % 7 as v").unionByName(spark.sql("select cast(null as bigint) id, 1L v"))
    bucketed.create(rows, path, KEYS, 16)
    return path, spark.createDataFrame([], rows.schema)


def upsert(old, new):
    return delete_insert(old, new, KEYS)


def bucket(spark, key):
    return spark.createDataFrame([(key,)], "id bigint").select(bucketed.bucket_of(KEYS, 16)).first()[0]


def test_only_touched_buckets_are_read_and_replaced(spark, table):
    path, like = table
    hit = bucket(spark, 5)
    files = {f: pathlib.Path(f).stat().st_mtime_ns for f in glob.glob(f"{path}/bucket=*/*.parquet")}
    for f in files:  # a read of any other bucket would fail
        if f"bucket={hit}/" not in f:
            pathlib.Path(f).write_bytes(b"unreadable")
    changes = spark.createDataFrame([(5, 100), (None, 7)], "id bigint, v bigint")
    before = bucketed.touched(bucketed._scan(spark, path, like, KEYS), changes.filter("id is not null"), KEYS, 16)
    assert {r.bucket for r in before.collect()} == {hit}
    bucketed.merge(changes, path, like, KEYS, upsert, 1, 16)
    left = set(glob.glob(f"{path}/bucket=*/*.parquet"))
    assert {f for f in files if f"bucket={hit}/" not in f} <= left and not {f for f in files if f"bucket={hit}/" in f} & left
    own = spark.read.parquet(f"{path}/bucket={hit}").filter("id is not null")
    assert {r.id: r.v for r in own.collect()}[5] == 100 and own.count() > 5


def test_replay_and_several_batches(spark, table, rows):
    path, like = table
    for batch, (ids, v) in enumerate([((1, 2, 900), 10), ((1, 2, 900), 10), ((2, 901), 20)], 1):
        bucketed.merge(spark.createDataFrame([(i, v) for i in ids], "id bigint, v bigint"), path, like, KEYS, upsert, min(batch, 2), 16)
    found = {r.id: r.v for r in bucketed.read(spark, path, like, KEYS).collect()}
    assert len(found) == 402 and (found[1], found[2], found[900], found[901], found[3]) == (10, 20, 10, 20, 3)
    bucketed.merge(like, path, like, KEYS, upsert, 9, 16)
    assert bucketed.read(spark, path, like, KEYS).count() == 402


def test_a_bucket_that_loses_its_last_row(spark):
    path = scratch_path(spark, "bucketed")
    rows = spark.createDataFrame([(1, 1), (2, 1)], "id bigint, v bigint")
    bucketed.create(rows, path, KEYS, 64)
    gone = spark.createDataFrame([(1, 2, "x")], "id bigint, v bigint, deleted string")
    bucketed.merge(gone, path, rows, KEYS, lambda old, new: apply_cdc(old, new, KEYS, ["v"], "deleted"), 1, 64)
    assert [tuple(r) for r in bucketed.read(spark, path, rows, KEYS).collect()] == [(2, 1)]
    bucketed.merge(rows.filter("id = 1"), path, rows, KEYS, upsert, 2, 64)
    assert bucketed.read(spark, path, rows, KEYS).count() == 2
