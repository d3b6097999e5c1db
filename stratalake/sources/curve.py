"""Tables laid out along a space-filling curve, so that a range of any of several keys is found in few folders.

Each key is cut into ranges of about equally many rows; the bits of a row's range numbers, taken in turn, are its place on the curve.
Folders hold stretches of the curve, and a manifest keeps the least and largest value of every key for each of them. A reader leaves out
folders by the manifest before files are listed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART, CUTS, PLACE = "part", "curve_cuts", "curve_place"
#: Bits of a key's range number, folders of a table.
BITS, PARTS = 6, 64


def bounds(df: DataFrame, keys: Sequence[str], bits: int = BITS) -> Column:
    """Scalar subquery: a struct with the upper bounds of all ranges but the last of each key, by place; sketched quantiles."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    cuts = [F.percentile_approx(F.col(f"`{k}`"), shares, 10_000).alias(f"b{i}") for i, k in enumerate(keys)]
    return df.agg(F.struct(*cuts).alias("bounds")).select("bounds").scalar()


def range_number(key: str, cuts: Column) -> Column:
    """Number of bounds below the value; NULL values come first."""
    value = F.col(f"`{key}`")
    return F.when(value.isNull(), 0).otherwise(F.coalesce(F.size(F.filter(cuts, lambda cut: cut < value)), F.lit(0))).cast("long")


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """Place on the curve: the highest bits of all numbers in turn, then the next ones."""
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for k, number in enumerate(numbers):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1).cast("long"))
            place = place.bitwiseOR(F.shiftleft(one, (bit + 1) * len(numbers) - 1 - k))
    return place


def write_curve(df: DataFrame, path: str, keys: Sequence[str], parts: int = PARTS, bits: int = BITS) -> str:
    """Write ``path/rows`` in folders along the curve and ``path/manifest``; numbers, dates and timestamps can be keys.

    A place that holds many rows, such as one frequent combination of keys, is divided by a hash of the whole row.
    """
    if not keys or len(keys) * bits > 62:
        raise ValueError("one key at least, and 62 bits of all keys at most")
    # The bounds are a column, since Spark allows no subquery inside the function of a filter.
    cut = df.withColumn(CUTS, bounds(df, keys, bits))
    place = interleaved([range_number(k, F.col(CUTS)[f"b{i}"]) for i, k in enumerate(keys)], bits)
    placed = cut.withColumn(PLACE, place).drop(CUTS)
    dealt = placed.repartitionByRange(parts, PLACE, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])).drop(PLACE)
    dealt.withColumn(PART, F.spark_partition_id()).write.mode("overwrite").partitionBy(PART).parquet(f"{path}/rows")
    rows = _rows(df.sparkSession, path, df.schema)
    ends = [f(F.col(f"`{k}`")).alias(f"{n}{i}") for i, k in enumerate(keys) for n, f in (("least", F.min), ("most", F.max))]
    rows.groupBy(PART).agg(F.count("*").alias("rows"), *ends).write.mode("overwrite").parquet(f"{path}/manifest")
    return path


def touched_parts(spark: SparkSession, path: str, keys: Sequence[str], ranges: Mapping[str, tuple]) -> DataFrame:
    """Manifest rows of the folders that may hold a row with every key in its range, both ends included."""
    kept = spark.read.parquet(f"{path}/manifest")
    for key, (low, high) in ranges.items():
        i = list(keys).index(key)
        kept = kept.filter((F.col(f"most{i}") >= F.lit(low)) & (F.col(f"least{i}") <= F.lit(high)))
    return kept


def read_range(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], ranges: Mapping[str, tuple]) -> DataFrame:
    """Rows with every key in its range; folders that cannot hold one are not listed."""
    parts = touched_parts(spark, path, keys, ranges).agg(F.collect_set(PART)).scalar()
    rows = _rows(spark, path, schema).filter(F.array_contains(parts, F.col(PART)))
    for key, (low, high) in ranges.items():
        rows = rows.filter(F.col(f"`{key}`").between(F.lit(low), F.lit(high)))
    return rows.drop(PART)


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.IntegerType())])).parquet(f"{path}/rows")
