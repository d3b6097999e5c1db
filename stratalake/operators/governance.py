"""Column usage from the query log, lineage, schema evolution and drift, catalogue, run metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.dates import as_date, as_timestamp
from stratalake.operators.quality import row_counts, union_all

# A column is hot from 5 queries on; key words that make a statement unsafe.
HOT_THRESHOLD = 5
UNSAFE_KEYWORDS = [
    "drop", "delete", "insert", "update", "truncate", "alter", "create", "replace", "rename", "attach",
    "detach", "optimize", "system reload", "system drop",
]
MODEL_PREFIXES = ["fct_", "dim_", "stg_", "mart_"]
MODEL_SCHEMAS = ["gold", "staging"]
RUN_TABLES = ("fct_orders", "dim_customers")


# ---- column usage ------------------------------------------------------------------------------------


def finished_selects(log: DataFrame, as_of, hours: int = 24, schema: str = "gold.") -> DataFrame:
    """Successful SELECTs of the last hours that mention the schema."""
    since = as_timestamp(as_of) - F.make_dt_interval(F.lit(0), F.lit(hours))
    return log.filter(
        (F.col("event_time") >= since)
        & (F.col("type") == "QueryFinish")
        & (F.col("query_kind") == "Select")
        & F.contains(F.lower("query"), F.lit(schema))
    )


def _mentions(queries: DataFrame, names: DataFrame, whole_word: bool) -> DataFrame:
    """Queries and last query time per mentioned name, whatever the number of names.

    A name of word characters is mentioned inside a word of the text. The log's distinct words, its vocabulary, are cut into the
    pieces that are as long as some name, and these are joined with the names by equality; texts are never copied. Names with
    other characters, rare among columns, are searched in the whole text.
    """
    numbered = queries.select("event_time", F.lower("query").alias("text"), F.monotonically_increasing_id().alias("row"))
    words = numbered.select("row", "event_time", F.explode(F.array_distinct(F.split("text", "[^a-z0-9_]+"))).alias("word")).filter("word <> ''")
    if whole_word:
        hits = words.select("event_time", F.col("word").alias("name")).join(names, "name", "left_semi")
    else:
        plain = names.filter(F.col("name").rlike("^[a-z0-9_]+$"))
        lengths = plain.agg(F.coalesce(F.collect_set(F.length("name")), F.array().cast("array<int>"))).scalar()
        vocabulary = words.select("word").distinct().withColumn("length", F.explode(lengths)).filter(F.length("word") >= F.col("length"))
        starts = F.sequence(F.lit(1), F.length("word") - F.col("length") + 1)
        pieces = F.array_distinct(F.transform(starts, lambda i: F.substr(F.col("word"), i, F.col("length"))))
        held = vocabulary.select("word", F.explode(pieces).alias("name")).join(plain, "name").distinct()
        inside = words.join(held, "word").select("row", "event_time", "name").distinct()
        odd = names.filter(~F.col("name").rlike("^[a-z0-9_]+$")).agg(F.collect_list("name")).scalar()
        anywhere = numbered.withColumn("names", odd).filter(F.size("names") > 0)
        bound = F.element_at(F.transform(F.array("text"), lambda t: F.filter("names", lambda n: F.contains(t, n))), 1)
        hits = inside.select("event_time", "name").unionByName(anywhere.select("event_time", F.explode(bound).alias("name")))
    return hits.groupBy("name").agg(F.count("*").alias("hits"), F.max("event_time").alias("last_queried_at"))


def column_usage(log: DataFrame, catalog: DataFrame, as_of, hours: int = 24, whole_word: bool = False) -> DataFrame:
    """Number of queries that mention each catalogue column, columns never mentioned included.

    ``catalog`` has schema_name, table_name, column_name. A mention is a substring match on the column
    name (so ``id`` is mentioned by ``user_id``) unless ``whole_word`` is set.
    """
    queries = finished_selects(log, as_of, hours)
    names = catalog.select(F.lower("column_name").alias("name")).distinct()
    used = _mentions(queries, names, whole_word)
    keyed = catalog.withColumn("name", F.lower("column_name"))
    return keyed.join(used, "name", "left").select(
        "schema_name",
        "table_name",
        "column_name",
        F.coalesce("hits", F.lit(0)).alias("query_count_24h"),
        "last_queried_at",
        as_date(as_of).alias("captured_at"),
    )


def hot_cold(usage: DataFrame) -> DataFrame:
    """One row: all, hot and cold columns."""
    n = F.col("query_count_24h")
    return usage.agg(
        F.count("*").alias("columns"), F.count_if(n >= HOT_THRESHOLD).alias("hot"), F.count_if(n == 0).alias("cold")
    )


def hot_tables(usage: DataFrame) -> DataFrame:
    return usage.filter(F.col("query_count_24h") >= HOT_THRESHOLD).select("schema_name", "table_name").distinct()


def deprecations(usage: DataFrame) -> DataFrame:
    """Never-mentioned columns per table, in name order (a table has a bounded number of columns)."""
    cold = usage.filter(F.col("query_count_24h") == 0)
    listed = F.array_join(F.array_sort(F.collect_list("column_name")), ", ")
    return cold.groupBy("schema_name", "table_name").agg(F.count("*").alias("cold_columns"), listed.alias("columns"))


def top_columns(usage: DataFrame, n: int = 20) -> DataFrame:
    shown = usage.select("schema_name", "table_name", "column_name", "query_count_24h")
    return shown.orderBy(F.desc("query_count_24h"), "schema_name", "table_name", "column_name").limit(n)


# ---- statements --------------------------------------------------------------------------------------


def flag_unsafe_sql(log: DataFrame) -> DataFrame:
    """Whether a statement contains a data-changing key word as a whole word."""
    pattern = r"\b(" + "|".join(UNSAFE_KEYWORDS) + r")\b"
    text = F.regexp_replace(F.lower("query"), r"\s+", " ")
    return log.select("query_id", text.rlike(pattern).alias("is_unsafe"))


def table_refs(log: DataFrame) -> DataFrame:
    """(query_id, table_name): models a statement reads, each once."""
    pattern = rf"\b(?:{'|'.join(MODEL_SCHEMAS)})\.((?:{'|'.join(MODEL_PREFIXES)})\w+)\b"
    found = F.array_distinct(F.regexp_extract_all("query", F.lit(pattern), 1))
    return log.select("query_id", F.explode(found).alias("table_name"))


# ---- schemas -----------------------------------------------------------------------------------------


def schema_rows(tables: Mapping[str, DataFrame], schema: str) -> DataFrame:
    """Catalogue rows from the schemas of DataFrames: metadata only, no data is read."""
    rows = [
        (schema, table, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO")
        for table, df in tables.items()
        for f in df.schema.fields
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        rows, "schema_name string, table_name string, column_name string, data_type string, is_nullable string"
    )


def catalog(tables: Mapping[str, DataFrame], schema: str) -> DataFrame:
    """Columns with types, and the row count of their table."""
    counts = row_counts(tables)
    return schema_rows(tables, schema).join(counts, "table_name").select(
        "schema_name", "table_name", "column_name", "data_type", "row_count"
    )


def schema_evolution(current: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Columns that were added to or removed from the source since the snapshot."""
    keys = ["table_name", "column_name"]
    now = current.select(*keys, F.lit(True).alias("now"))
    then = snapshot.select(*keys, F.lit(True).alias("then"))
    both = now.join(then, keys, "full_outer")
    drift = F.when(F.col("then").isNull(), "added").when(F.col("now").isNull(), "removed")
    return both.select(*keys, drift.alias("drift_type")).filter(F.col("drift_type").isNotNull())


def next_snapshot(current: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Snapshot with the added columns; removed ones stay because they may come back."""
    return snapshot.unionByName(current.join(snapshot, ["table_name", "column_name"], "left_anti").select(*snapshot.columns))


def drift_alerts(evolution: DataFrame, source_db: str, detected_at) -> DataFrame:
    """Alert rows for removed columns."""
    removed = evolution.filter(F.col("drift_type") == "removed")
    return removed.select(
        F.lit(source_db).alias("source_db"), "table_name", "column_name", "drift_type", as_timestamp(detected_at).alias("detected_at")
    )


def schema_drift(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Declared against actual columns: added and removed names per drifting table."""
    keys = ["table_name", "column_name"]
    added = actual.select(*keys).exceptAll(expected.select(*keys)).withColumn("kind", F.lit("added"))
    removed = expected.select(*keys).exceptAll(actual.select(*keys)).withColumn("kind", F.lit("removed"))
    only = lambda kind: F.when(F.col("kind") == kind, F.col("column_name"))
    listed = lambda kind: F.array_join(F.array_sort(F.collect_set(only(kind))), ", ")
    return added.unionByName(removed).groupBy("table_name").agg(listed("added").alias("added"), listed("removed").alias("removed"))


# ---- run metadata ------------------------------------------------------------------------------------


def log_run(tables: Mapping[str, DataFrame], run_date, run_id: str, dag_id: str) -> DataFrame:
    """One metadata row: counts of the key tables and of all tables together."""
    counts = row_counts(tables)
    of = lambda name: F.sum(F.when(F.col("table_name") == name, F.col("row_count")))
    fixed: dict[str, Column] = {"run_date": as_date(run_date), "run_id": F.lit(run_id), "dag_id": F.lit(dag_id)}
    return counts.agg(
        *[of(name).alias(f"{name}_rows") for name in RUN_TABLES], F.sum("row_count").alias("gold_tables_rows")
    ).select(*[c.alias(n) for n, c in fixed.items()], *[f"{name}_rows" for name in RUN_TABLES], "gold_tables_rows")
