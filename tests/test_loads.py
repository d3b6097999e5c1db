"""Loads into a stored target: what they read and write, and repeats."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F

from stratalake.plans.loads import build_model, load_model, read_model
from stratalake.sources import versioned

SCHEMA = "id bigint, value string, ts timestamp"


def at(hour):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def test_loads_write_new_rows_only_and_may_be_repeated(spark, tmp_path, rows):
    model = lambda df: df.withColumn("value", F.upper("value"))
    first = [(i, "a", at(i)) for i in range(50)]
    later = [(3, "b", at(60)), (90, "c", at(61))]
    target = str(tmp_path / "target")
    build_model(model, spark.createDataFrame(first, SCHEMA), target)
    source = spark.createDataFrame(first + later, SCHEMA)
    for _ in range(2):
        load_model(model, source, target, "ts", 1)
    load_model(model, source, target, "ts", 2)
    written = {p.name: spark.read.parquet(str(p)).count() for p in pathlib.Path(target).glob("batch_id=*")}
    # Beside the new rows a load takes those of the lookback: hours 48 and 49, then 60 and 61.
    assert written == {"batch_id=0": 50, "batch_id=1": 4, "batch_id=2": 2}
    expected = {i: (i, "A", at(i)) for i in range(50)} | {3: (3, "B", at(60)), 90: (90, "C", at(61))}
    assert rows(read_model(source, target, ["id"], "ts")) == sorted(expected.values(), key=str)


VERSIONS = [(1, None, 1, 0), (1, "b", 2, 1), (None, "c", 1, 0), (None, "d", 1, 1), (3, "e", 5, 0), (4, "f", 3, 1), (4, "g", 4, 0), (5, None, None, 0)]


def versions(spark, tmp_path):
    for batch in (0, 1):
        df = spark.createDataFrame([(k, v, t) for k, v, t, b in VERSIONS if b == batch], "id bigint, value string, ts bigint")
        versioned.write_batch(df, str(tmp_path), batch)
    return str(tmp_path)


@pytest.mark.parametrize("few", [0, 1000])
def test_current_rows_whatever_the_number_of_repeated_keys(spark, tmp_path, rows, monkeypatch, few):
    monkeypatch.setattr(versioned, "FEW_KEYS", few)
    found = versioned.read_target(spark, versions(spark, tmp_path), ["id"], "ts")
    assert rows(found) == sorted([(1, "b", 2), (None, "d", 1), (3, "e", 5), (4, "g", 4), (5, None, None)], key=str)


def test_rows_with_one_version_are_not_shuffled(spark, tmp_path):
    found = versioned.read_target(spark, versions(spark, tmp_path), ["id"], "ts")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and plan.count("Exchange hashpartitioning") == 1
