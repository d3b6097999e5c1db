"""Data-quality checks. Every check result is a DataFrame; one scan per table however many rules it has."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.dates import as_date, as_timestamp
from stratalake.operators.integrity import orphans

# Thresholds and penalties.
MAX_NULL_RATE = 0.001
DROP_ANOMALY_PCT = -25
COUNT_DEVIATION = 0.5
HEALTH_PENALTIES = {"row_count": 30, "null_rate": 10, "duplicates": 30, "orphans": 15, "stale": 10}
HEALTH_BANDS = {"HEALTHY": 90, "WARNING": 70}
MIN_COUNT_SHARE = 0.5
MAX_KEY_NULL_PCT = 1.0
MAX_STALE_DAYS = 2


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def unpivot_rows(row: DataFrame, entries: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One output row per entry from a single aggregate row."""
    structs = [F.struct(*[c.alias(n) for n, c in entry.items()]) for entry in entries]
    return row.select(F.explode(F.array(*structs)).alias("entry")).select("entry.*")


# ---- expectations ------------------------------------------------------------------------------------


def _text(value) -> Column:
    return F.lit(value).cast("string")


def _rule(name: str, expectation: Mapping) -> tuple[dict[str, Column], Column | None, Column]:
    """Aggregates an expectation needs, its unexpected count and its observed value."""
    kind, args = expectation["expectation_type"], expectation["kwargs"]
    col = F.col(f"`{args['column']}`") if "column" in args else None
    lower, upper = args.get("min_value"), args.get("max_value")
    measured = F.col(name)
    if kind == "expect_table_row_count_to_be_between":
        return {name: F.count("*")}, None, measured
    if kind == "expect_column_values_to_not_be_null":
        return {name: F.count_if(col.isNull())}, measured, measured
    if kind == "expect_column_values_to_be_in_set":
        return {name: F.count_if(~col.isin(*args["value_set"]))}, measured, measured
    if kind == "expect_column_values_to_be_between":
        outside = F.lit(False)
        if lower is not None:
            outside = outside | (col < F.lit(lower))
        if upper is not None:
            outside = outside | (col > F.lit(upper))
        return {name: F.count_if(outside)}, measured, measured
    known, distinct = f"{name}_known", f"{name}_distinct"
    both = {known: F.count(col), distinct: F.count_distinct(col)}
    if kind == "expect_column_values_to_be_unique":
        repeated = F.col(known) - F.col(distinct)
        return both, repeated, repeated
    if kind == "expect_column_proportion_of_unique_values_to_be_between":
        return both, None, F.try_divide(F.col(distinct), F.col(known))
    raise ValueError(f"unknown expectation {kind!r}")


def validate(df: DataFrame, suite: Mapping) -> DataFrame:
    """Evaluate a whole suite in one aggregation over the table.

    Result rows: suite, position, expectation_type, column, observed, success. NULL values are skipped by
    every rule but the not-null one. A rule on a missing column fails with an unknown observation.
    """
    aggregates: dict[str, Column] = {}
    entries = []
    for place, expectation in enumerate(suite["expectations"]):
        kind, args = expectation["expectation_type"], expectation["kwargs"]
        column = args.get("column")
        exists = column is None or column in df.columns
        if kind == "expect_column_to_exist":
            observed, success = F.lit(float(exists)), F.lit(exists)
        elif not exists:
            observed, success = F.lit(None).cast("double"), F.lit(False)
        else:
            needed, unexpected, value = _rule(f"e{place}", expectation)
            aggregates |= needed
            observed = value.cast("double")
            if unexpected is not None:
                success = unexpected == 0
            else:
                success = F.lit(True)
                if args.get("min_value") is not None:
                    success = success & (observed >= F.lit(float(args["min_value"])))
                if args.get("max_value") is not None:
                    success = success & (observed <= F.lit(float(args["max_value"])))
        entries.append(
            {
                "suite": F.lit(suite["expectation_suite_name"]),
                "position": F.lit(place),
                "expectation_type": F.lit(kind),
                "column": _text(column),
                "observed": observed,
                "success": F.coalesce(success, F.lit(False)),
            }
        )
    aggregates.setdefault("rows_seen", F.count("*"))
    return unpivot_rows(df.agg(*[c.alias(n) for n, c in aggregates.items()]), entries)


def run_checkpoint(suites: Sequence[tuple[DataFrame, Mapping]]) -> DataFrame:
    """Evaluated and failed rules per suite and whether it passed."""
    results = union_all([validate(df, suite) for df, suite in suites])
    return results.groupBy("suite").agg(
        F.count("*").alias("evaluated"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"),
    )


# ---- declared schema tests ---------------------------------------------------------------------------


def run_schema_tests(tables: Mapping[str, DataFrame], suite: Mapping[str, Mapping[str, Sequence]]) -> DataFrame:
    """Generic column tests: ``unique``, ``not_null``, ``{"accepted_values": [...]}``,
    ``{"relationships": (table, column)}``.

    Result rows: table_name, column_name, test, failures. All tests of a table but the relationships run
    in one aggregation; failures are violating rows (for ``unique``: rows minus distinct values).
    """
    parts = []
    for table, columns in suite.items():
        aggregates, entries, relations = [], [], []
        for column, tests in columns.items():
            for test in tests:
                kind, arg = (test, None) if isinstance(test, str) else next(iter(test.items()))
                if kind == "relationships":
                    relations.append((column, *arg))
                    continue
                col, name = F.col(column), f"t{len(aggregates)}"
                failures = {
                    "unique": lambda c=col: F.count(c) - F.count_distinct(c),
                    "not_null": lambda c=col: F.count_if(c.isNull()),
                    "accepted_values": lambda c=col, a=arg: F.count_if(~c.isin(*a)),
                }[kind]()
                aggregates.append(failures.alias(name))
                entries.append(
                    {
                        "table_name": F.lit(table),
                        "column_name": F.lit(column),
                        "test": F.lit(kind),
                        "failures": F.col(name).cast("bigint"),
                    }
                )
        if aggregates:
            parts.append(unpivot_rows(tables[table].agg(*aggregates), entries))
        for column, parent, parent_column in relations:
            lost = orphans(tables[table], tables[parent], column, parent_column, null_is_orphan=False)
            parts.append(
                lost.select(
                    F.lit(table).alias("table_name"),
                    F.lit(column).alias("column_name"),
                    F.lit("relationships").alias("test"),
                    F.col("orphans").cast("bigint").alias("failures"),
                )
            )
    return union_all(parts)


# ---- counts ------------------------------------------------------------------------------------------


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all([df.agg(F.count("*").alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()])


def row_count_anomaly(history: DataFrame, runs: int = 7, deviation: float = COUNT_DEVIATION) -> DataFrame:
    """Each run's count next to the mean of the ``runs`` runs before it; flagged beyond the deviation."""
    before = Window.partitionBy("pipeline", "table_name").orderBy("run_date").rowsBetween(-runs, -1)
    mean = F.avg("row_count").over(before)
    off = F.abs(F.col("row_count") - F.col("mean_count")) > F.col("mean_count") * deviation
    return history.withColumn("mean_count", mean).withColumn("is_anomaly", F.coalesce(off, F.lit(False)))


def previous_runs(history: DataFrame) -> DataFrame:
    """Every run with the row count of the same table's run before; a table has one run per day."""
    before = F.lag("row_count").over(Window.partitionBy("pipeline", "table_name").orderBy("run_date"))
    return history.select("run_date", "pipeline", "table_name", "row_count", before.alias("prev_count"))


def observability(history: DataFrame, current: DataFrame, run_date) -> DataFrame:
    """Current counts against the latest earlier run of each table; a drop of more than 25% is an anomaly."""
    earlier = history.filter(F.col("run_date") < as_date(run_date))
    latest = earlier.groupBy("pipeline", "table_name").agg(F.max_by("row_count", "run_date").alias("known_count"))
    joined = current.join(latest, ["pipeline", "table_name"], "left")
    now, prev = F.col("row_count"), F.coalesce("known_count", "row_count")
    delta = F.round((now - prev).cast("double") / F.greatest(prev, F.lit(1)) * 100, 2)
    return joined.select(
        as_date(run_date).alias("run_date"),
        "pipeline",
        "table_name",
        "row_count",
        prev.alias("prev_count"),
        delta.alias("delta_pct"),
        F.when((prev > 0) & (delta < DROP_ANOMALY_PCT), "anomaly").otherwise("ok").alias("status"),
    )


def quality_checks(checks: Mapping[str, tuple[DataFrame, Mapping[str, tuple[Column, int]]]]) -> DataFrame:
    """Minimum-count and zero-violation rules.

    Per table: rule name -> (aggregate, expected). An expectation above 0 is a minimum, 0 means none.
    Result rows: check, value, expected, ok. One aggregation per table.
    """
    parts = []
    for _, (df, rules) in checks.items():
        names = {rule: f"c{i}" for i, rule in enumerate(rules)}
        row = df.agg(*[aggregate.alias(names[rule]) for rule, (aggregate, _) in rules.items()])
        entries = []
        for rule, (_, expected) in rules.items():
            value = F.col(names[rule]).cast("bigint")
            entries.append(
                {
                    "check": F.lit(rule),
                    "value": value,
                    "expected": F.lit(expected).cast("bigint"),
                    "ok": (value >= expected) if expected > 0 else (value == expected),
                }
            )
        parts.append(unpivot_rows(row, entries))
    return union_all(parts)


def is_blank(df: DataFrame, name: str) -> Column:
    """NULL or, in a text column, empty."""
    col = F.col(f"`{name}`")
    return col.isNull() | (col == "") if isinstance(df.schema[name].dataType, T.StringType) else col.isNull()


def null_rates(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]], max_rate: float = MAX_NULL_RATE, blank_is_null: bool = False
) -> DataFrame:
    """Null rate of the named columns against a maximum; empty tables give no row."""
    missing = is_blank if blank_is_null else (lambda df, c: F.col(f"`{c}`").isNull())
    parts = []
    for table, (df, columns) in tables.items():
        row = df.agg(F.count("*").alias("total"), *[F.count_if(missing(df, c)).alias(f"n_{c}") for c in columns])
        entries = []
        for c in columns:
            rate = F.try_divide(F.col(f"n_{c}").cast("double"), F.col("total"))
            entries.append({"table_name": F.lit(table), "column_name": F.lit(c), "null_rate": rate, "ok": rate <= max_rate})
        parts.append(unpivot_rows(row.filter(F.col("total") > 0), entries))
    return union_all(parts)


def null_rate_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percent of NULL or empty values of every column with its band, in one aggregation."""
    names = list(columns or df.columns)
    row = df.agg(F.count("*").alias("total"), *[F.count_if(is_blank(df, c)).alias(f"n_{c}") for c in names])
    entries = []
    for c in names:
        pct = F.round(F.try_divide(F.col(f"n_{c}") * F.lit(100.0), F.col("total")), 2)
        band = F.when(pct == 0, "OK").when(pct <= 1, "WARN").otherwise("HIGH")
        entries.append({"column_name": F.lit(c), "null_pct": pct, "status": band})
    return unpivot_rows(row, entries)


def duplicate_count(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys and their difference (so every NULL key counts as a duplicate)."""
    row = df.agg(F.count("*").alias("total"), F.count_distinct(key).alias("uniq"))
    return row.withColumn("duplicates", F.col("total") - F.col("uniq"))


def freshness(tables: Mapping[str, tuple[DataFrame, str, float, float]], as_of) -> DataFrame:
    """Age of the newest row in hours per table; entries are (table, time column, warn hours, error hours)."""
    parts = []
    for name, (df, ts, warn, error) in tables.items():
        newest = df.agg(F.max(ts).alias("newest"))
        age = F.round((F.unix_timestamp(as_timestamp(as_of)) - F.unix_timestamp("newest")) / 3600, 2)
        parts.append(
            newest.select(F.lit(name).alias("table_name"), "newest", age.alias("age_hours")).withColumn(
                "status",
                F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error), "error")
                .when(F.col("age_hours") > warn, "warn")
                .otherwise("pass"),
            )
        )
    return union_all(parts)


# ---- assertions: the violating rows ------------------------------------------------------------------


def assert_dau_non_negative(dau: DataFrame) -> DataFrame:
    return dau.filter((F.col("dau") < 0) | (F.col("total_events") < 0)).select("event_date", "dau", "total_events")


def assert_one_current(dim: DataFrame) -> DataFrame:
    counts = dim.filter(F.col("is_current") == 1).groupBy("customer_id").agg(F.count("*").alias("current_count"))
    return counts.filter(F.col("current_count") > 1)


def assert_revenue_consistency(fact: DataFrame) -> DataFrame:
    wrong = (F.col("status") == "completed") & (F.col("revenue") <= 0)
    return fact.filter(wrong).select("order_id", "status", "amount", "revenue")


def assert_positive(df: DataFrame, column: str, *shown: str) -> DataFrame:
    return df.filter(F.col(column) <= 0).select(*shown, column)


def assert_non_negative(df: DataFrame, column: str, *shown: str) -> DataFrame:
    return df.filter(F.col(column) < 0).select(*shown, column)


def assert_no_future(df: DataFrame, ts: str, as_of, *shown: str) -> DataFrame:
    return df.filter(F.col(ts) > as_timestamp(as_of)).select(*shown, ts)


def assert_non_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Whether each table has a row; one row per table is looked at."""
    parts = []
    for name, df in tables.items():
        parts.append(df.limit(1).agg((F.count("*") > 0).alias("ok")).select(F.lit(name).alias("table_name"), "ok"))
    return union_all(parts)


# ---- health score ------------------------------------------------------------------------------------


def health_score(measured: DataFrame) -> DataFrame:
    """Score from rows (kind, name, value, expected).

    Kinds: ``row_count`` (below half the expected count), ``null_rate`` (percent above 1), ``duplicates``
    and ``orphans`` (above 0), ``stale`` (more than 2 days behind).
    """
    kind, value = F.col("kind"), F.col("value")
    bad = (
        ((kind == "row_count") & (value < F.col("expected") * MIN_COUNT_SHARE))
        | ((kind == "null_rate") & (value > MAX_KEY_NULL_PCT))
        | (kind.isin("duplicates", "orphans") & (value > 0))
        | ((kind == "stale") & (value > MAX_STALE_DAYS))
    )
    penalty = F.lit(0)
    for name, points in HEALTH_PENALTIES.items():
        penalty = F.when(kind == name, points).otherwise(penalty)
    total = F.coalesce(F.sum(F.when(bad, penalty).otherwise(0)), F.lit(0))
    score = measured.agg(F.greatest(F.lit(0), 100 - total).cast("bigint").alias("score"))
    band = F.lit("CRITICAL")
    for name, least in sorted(HEALTH_BANDS.items(), key=lambda item: item[1]):
        band = F.when(F.col("score") >= least, name).otherwise(band)
    return score.withColumn("band", band)


def measured(kind: str, name: str, row: DataFrame, value: Column, expected: float | None = None) -> DataFrame:
    """One input row for :func:`health_score` from an aggregate row."""
    return row.select(
        F.lit(kind).alias("kind"),
        F.lit(name).alias("name"),
        value.cast("double").alias("value"),
        F.lit(expected).cast("double").alias("expected"),
    )
