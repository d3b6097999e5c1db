"""Tables along a space-filling curve."""

import datetime as dt
import pathlib
import shutil

import pytest
from pyspark.sql import functions as F

from stratalake.sources import curve

KEYS = ["a", "b", "day"]


def content(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    """20,000 rows with three independent keys; a third of the rows is one combination, some keys are NULL."""
    i = F.col("id")
    spread = lambda seed, n: F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(n))
    hot = i % 3 == 0
    return spark.range(20_000, numPartitions=5).select(
        i.alias("row"),
        F.when(hot, 500).when(i % 101 == 0, F.lit(None)).otherwise(spread(1, 1000)).alias("a"),
        F.when(hot, 0.5).otherwise(spread(2, 10_000) / 10_000).alias("b"),
        F.when(hot, F.lit("2024-06-01").cast("date")).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), spread(3, 366).cast("int"))).alias("day"),
    )


@pytest.fixture(scope="module")
def path(spark, rows, tmp_path_factory):
    return curve.write_curve(rows, f"{tmp_path_factory.mktemp('curve')}/t", KEYS)


def test_every_row_is_written_once(spark, rows, path):
    assert content(curve.read_range(spark, path, rows.schema, KEYS, {})) == content(rows)
    manifest = spark.read.parquet(f"{path}/manifest")
    assert manifest.agg(F.sum("rows")).first()[0] == 20_000


def test_a_frequent_combination_is_divided(spark, path):
    assert spark.read.parquet(f"{path}/manifest").agg(F.max("rows")).first()[0] < 20_000 / 64 * 3


@pytest.mark.parametrize("ranges", [{"a": (100, 150)}, {"b": (0.9, 0.95)}, {"day": (dt.date(2024, 2, 1), dt.date(2024, 2, 9))}])
def test_a_range_of_any_key_reads_few_folders(spark, rows, path, ranges):
    key, (low, high) = next(iter(ranges.items()))
    assert content(curve.read_range(spark, path, rows.schema, KEYS, ranges)) == content(rows.filter(F.col(key).between(low, high)))
    assert 0 < curve.touched_parts(spark, path, KEYS, ranges).count() <= 64 / 2


def test_ranges_of_all_keys_read_fewer(spark, rows, path):
    ranges = {"a": (100, 150), "b": (0.2, 0.3), "day": (dt.date(2024, 2, 1), dt.date(2024, 3, 9))}
    assert curve.touched_parts(spark, path, KEYS, ranges).count() <= 64 / 8
    wanted = F.lit(True)
    for key, (low, high) in ranges.items():
        wanted = wanted & F.col(key).between(low, high)
    assert content(curve.read_range(spark, path, rows.schema, KEYS, ranges)) == content(rows.filter(wanted))


def test_other_folders_are_not_opened(spark, rows, path, tmp_path):
    """All folders the manifest rules out hold unreadable files."""
    broken = f"{tmp_path}/t"
    shutil.copytree(path, broken)
    ranges = {"b": (0.9, 0.95)}
    needed = {r.part for r in curve.touched_parts(spark, broken, KEYS, ranges).collect()}
    for file in pathlib.Path(broken, "rows").glob("part=*/*.parquet"):
        if int(file.parent.name.split("=")[1]) not in needed:
            file.write_bytes(b"nothing")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    found = curve.read_range(spark, broken, rows.schema, KEYS, ranges)
    assert content(found) == content(rows.filter(F.col("b").between(0.9, 0.95)))


def test_bits_are_taken_in_turn(spark):
    numbers = spark.createDataFrame([(0b11, 0b00), (0b00, 0b11), (0b10, 0b01)], "x bigint, y bigint")
    found = numbers.select(curve.interleaved([F.col("x"), F.col("y")], 2).alias("z"))
    assert [r.z for r in found.collect()] == [0b1010, 0b0101, 0b1001]


def test_empty_tables_and_nulls_only(spark, tmp_path):
    for k, data in enumerate(([], [(None, None), (None, 1)])):
        df = spark.createDataFrame(data, "x bigint, y bigint")
        path = curve.write_curve(df, f"{tmp_path}/{k}", ["x", "y"], 4)
        assert content(curve.read_range(spark, path, df.schema, ["x", "y"], {})) == content(df)
        assert curve.read_range(spark, path, df.schema, ["x", "y"], {"x": (0, 9)}).count() == 0


def test_senseless_layouts_are_refused(rows, tmp_path):
    with pytest.raises(ValueError):
        curve.write_curve(rows, f"{tmp_path}/t", [])
    with pytest.raises(ValueError):
        curve.write_curve(rows, f"{tmp_path}/t", KEYS, bits=21)
