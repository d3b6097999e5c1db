"""Contracts generated from data, as rows or as suite JSON."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.profiling import NUMERIC, few_valued, string_columns, value_counts
from stratalake.operators.quality import is_blank, unpivot_rows

# Columns that never get a not-null rule, and rule thresholds.
INTERNAL_COLUMNS = ("_sign", "_version")
KEY_SUFFIXES = ("_id", "_key")
FEW_VALUES = 20

ROW_COUNT = "expect_table_row_count_to_be_between"
EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"


def _entry(kind: str, column: str | None = None, low: Column | None = None, high: Column | None = None) -> dict[str, Column]:
    return {
        "expectation_type": F.lit(kind),
        "column": F.lit(column).cast("string"),
        "min_value": (F.lit(None) if low is None else low).cast("double"),
        "max_value": (F.lit(None) if high is None else high).cast("double"),
    }


def is_key(name: str) -> bool:
    return name.endswith(KEY_SUFFIXES) or name == "id"


def generate_contract(df: DataFrame, required: set[str] | None = None) -> DataFrame:
    """Rules from the schema and one aggregation: row count within 10% (+100), every column exists,
    required columns not null, required numbers between their extremes, ids and keys unique.

    ``required`` names the columns that may not be NULL; without it the schema's nullability decides.
    """
    fields = df.schema.fields
    needed = {f.name for f in fields if not f.nullable} if required is None else required
    aggregates = [F.count("*").alias("total")]
    total = F.col("total")
    entries = [_entry(ROW_COUNT, None, F.floor(total * F.lit(0.9)), F.floor(total * F.lit(1.1)) + 100)]
    for place, field in enumerate(fields):
        entries.append(_entry(EXISTS, field.name))
        if field.name in needed and field.name not in INTERNAL_COLUMNS:
            entries.append(_entry(NOT_NULL, field.name))
        if field.name in needed and isinstance(field.dataType, NUMERIC):
            col = F.col(f"`{field.name}`").cast("double")
            aggregates += [F.min(col).alias(f"min{place}"), F.max(col).alias(f"max{place}")]
            entries.append(_entry(BETWEEN, field.name, F.col(f"min{place}"), F.col(f"max{place}")))
        if field.name.endswith(KEY_SUFFIXES):
            entries.append(_entry(UNIQUE, field.name))
    return unpivot_rows(df.agg(*aggregates), entries)


def generate_stat_contract(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Rules from statistics: not null where nothing is missing, numbers between the 5th percentile and
    1.5 times the 95th, texts with few values in their set, half to double the rows, keys unique."""
    fields = df.schema.fields
    aggregates, entries = [F.count("*").alias("total")], []
    entries.append(_entry(ROW_COUNT, None, F.col("total") * 0.5, F.col("total") * 2) | {"when": F.lit(True)})
    for place, field in enumerate(fields):
        col = F.col(f"`{field.name}`")
        aggregates.append(F.count_if(is_blank(df, field.name)).alias(f"blank{place}"))
        entries.append(_entry(NOT_NULL, field.name) | {"when": F.col(f"blank{place}") == 0})
        if isinstance(field.dataType, NUMERIC):
            both = F.percentile_approx(col.cast("double"), [0.05, 0.95], accuracy)
            aggregates.append(both.alias(f"pct{place}"))
            pct = F.col(f"pct{place}")
            entries.append(_entry(BETWEEN, field.name, F.round(pct[0], 2), F.round(pct[1].cast("decimal(20,2)") * F.lit(Decimal("1.5")), 2)) | {"when": F.lit(True)})
        if is_key(field.name):
            entries.append(_entry(UNIQUE, field.name) | {"when": F.lit(True)})
    rules = unpivot_rows(df.agg(*aggregates), entries).filter("when").drop("when")
    texts = string_columns(df)
    if not texts:
        return rules.withColumn("value_set", F.lit(None).cast("string"))
    return rules.withColumn("value_set", F.lit(None).cast("string")).unionByName(value_sets(df, texts), allowMissingColumns=True)


def value_sets(df: DataFrame, texts: list[str], fewer_than: int = FEW_VALUES) -> DataFrame:
    """In-set rules for the text columns with fewer than 20 distinct values.

    Columns are narrowed by a sketch of their distinct count before their values are counted (with room for its error), and by
    the exact one after, so the value list holds at most 19 entries.
    """
    chosen = few_valued(df, texts, F.approx_count_distinct, 2 * fewer_than)
    counts = value_counts(df, texts, chosen).filter(F.col("value").isNotNull())
    small = counts.groupBy("column_name").agg(F.count("*").alias("n")).filter(F.col("n") < fewer_than).select("column_name")
    sets = counts.join(small, "column_name", "left_semi").groupBy("column_name")
    listed = sets.agg(F.array_join(F.array_sort(F.collect_list("value")), "|").alias("value_set"))
    return listed.select(F.lit(IN_SET).alias("expectation_type"), F.col("column_name").alias("column"), "value_set")


def contract_json(rules: DataFrame, name: str) -> DataFrame:
    """One suite document (name, json). A contract has a few rules per column, so one row holds it."""
    kwargs = F.struct("column", "min_value", "max_value")
    listed = F.sort_array(F.collect_list(F.struct("expectation_type", kwargs.alias("kwargs"))))
    document = F.to_json(F.struct(F.lit(name).alias("expectation_suite_name"), F.col("expectations")))
    return rules.agg(listed.alias("expectations")).select(F.lit(name).alias("name"), document.alias("json"))


RULE = T.StructType([T.StructField("expectation_type", T.StringType()), T.StructField("kwargs", T.StringType())])


def validate_contract(documents: DataFrame) -> DataFrame:
    """Structure check of JSON rule lists (column ``json``): every item needs a type and arguments.

    The column may hold the list itself or a suite document with an ``expectations`` list.
    """
    listed = F.coalesce(F.get_json_object("json", "$.expectations"), F.col("json"))
    rules = F.when(F.ltrim(listed).startswith("["), F.from_json(listed, T.ArrayType(RULE)))
    broken = F.filter(rules, lambda r: r["expectation_type"].isNull() | r["kwargs"].isNull())
    return documents.select(
        *[c for c in documents.columns if c != "json"],
        F.when(rules.isNull(), None).otherwise(F.size(rules)).alias("items"),
        F.when(rules.isNull(), None).otherwise(F.size(broken)).alias("broken"),
    ).withColumn("valid", F.coalesce((F.col("broken") == 0), F.lit(False)))


def list_suites(spark: SparkSession, path: str) -> DataFrame:
    """Suite name and number of rules of every JSON document below a path (one document per line or file)."""
    schema = T.StructType([T.StructField("expectation_suite_name", T.StringType()), T.StructField("expectations", T.ArrayType(RULE))])
    read = spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    return read.select(F.col("expectation_suite_name").alias("suite"), F.size("expectations").alias("expectations"))
