"""Column profiles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.dedup import first_n
from stratalake.operators.quality import is_blank, unpivot_rows
from stratalake.session import scratch_path

NUMERIC = (T.DoubleType, T.FloatType, T.IntegerType, T.LongType, T.ShortType, T.DecimalType)
#: Share of the rows on either side of a percentile's sketch within which its exact value is looked for: five times the sketch's error.
MARGIN = 5e-4
PROFILE_COLUMNS = "source string, column_name string, dtype string, row_count bigint, null_count bigint, null_rate double, min_val double, max_val double, mean_val double, stddev_val double, distinct_count bigint, top5_values string, error string"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def value_counts(df: DataFrame, columns: list[str], chosen: Column | None = None) -> DataFrame:
    """(column_name, value, rows) for several text columns in one pass; NULL is a value.

    ``chosen``, an array of column names (a scalar subquery), leaves out the other columns before anything is exploded.
    """
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in columns]
    if chosen is not None:
        pairs = [F.when(F.array_contains(chosen, c), p) for c, p in zip(columns, pairs)]
    long = df.select(F.explode(F.array(*pairs)).alias("pair")).filter("pair is not null").select("pair.*")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("rows"))


def top_values(counts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent values per column; equal counts in value order."""
    return first_n(counts, ["column_name"], [F.desc("rows"), F.col("value").asc_nulls_first()], n)


def top_values_text(counts: DataFrame, n: int = 5) -> DataFrame:
    """(column_name, top_values): the most frequent values joined by `` | `` in descending order."""
    ranked = top_values(counts, n).select("column_name", F.struct((-F.col("rows")).alias("order"), "value").alias("entry"))
    # At most n entries per column reach this collect_list.
    ordered = F.transform(F.array_sort(F.collect_list("entry")), lambda e: F.coalesce(e["value"], F.lit("NULL")))
    return ranked.groupBy("column_name").agg(F.array_join(ordered, " | ").alias("top_values"))


def profile(df: DataFrame, label: str) -> DataFrame:
    """Rows, nulls, numeric statistics, distinct count and five most frequent texts of every column.

    Two passes whatever the number of columns: one aggregate for all columns, one count of text values.
    An empty table gives the single column ``_empty_``.
    """
    numbers, texts = numeric_columns(df), string_columns(df)
    aggregates: list[Column] = [F.count("*").alias("total")]
    entries = []
    for place, field in enumerate(df.schema.fields):
        col = F.col(f"`{field.name}`")
        aggregates.append(F.count_if(col.isNull()).alias(f"null{place}"))
        stats = {"min_val": F.min, "max_val": F.max, "mean_val": F.avg, "stddev_val": F.stddev}
        shown = {name: F.lit(None).cast("double") for name in stats}
        if field.name in numbers:
            for name, function in stats.items():
                aggregates.append(function(col.cast("double")).alias(f"{name}{place}"))
                shown[name] = F.col(f"{name}{place}")
        entries.append(
            {
                "source": F.lit(label),
                "column_name": F.lit(field.name),
                "dtype": F.lit(field.dataType.simpleString()),
                "row_count": F.col("total"),
                "null_count": F.col(f"null{place}"),
                "null_rate": F.round(F.try_divide(F.col(f"null{place}").cast("double"), F.col("total")), 4),
                **shown,
            }
        )
    row = df.agg(*aggregates)
    empty = {"source": F.lit(label), "column_name": F.lit("_empty_"), "dtype": F.lit(None).cast("string"), "row_count": F.col("total")}
    empty |= {"null_count": F.lit(None).cast("bigint"), "null_rate": F.lit(None).cast("double")}
    empty |= {n: F.lit(None).cast("double") for n in ("min_val", "max_val", "mean_val", "stddev_val")}
    structs = lambda items: F.array(*[F.struct(*[c.alias(n) for n, c in e.items()]) for e in items])
    rows = F.when(F.col("total") == 0, structs([empty])).otherwise(structs(entries))
    base = row.select(F.explode(rows).alias("entry")).select("entry.*")
    if not texts:
        return base.withColumns({"distinct_count": F.lit(None).cast("bigint"), "top5_values": F.lit(None).cast("string")})
    counts = value_counts(df, texts)
    distinct = counts.groupBy("column_name").agg(F.count("*").alias("distinct_count"))
    top = top_values_text(counts).withColumnRenamed("top_values", "top5_values")
    return base.join(distinct, "column_name", "left").join(top, "column_name", "left").select(
        *base.columns, "distinct_count", "top5_values"
    )


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, cardinality) of every column with a value, exact, in one pass.

    Each value becomes a narrow row of its own, with a place per column type; NULL is no value.
    """
    kinds = list(dict.fromkeys(f.dataType for f in df.schema.fields))
    pairs = []
    for place, field in enumerate(df.schema.fields):
        col = F.col(f"`{field.name}`")
        values = [(col if kind == field.dataType else F.lit(None).cast(kind)).alias(f"v{i}") for i, kind in enumerate(kinds)]
        pairs.append(F.when(col.isNotNull(), F.struct(F.lit(place).alias("place"), *values)))
    long = df.select(F.explode(F.array(*pairs)).alias("pair")).filter("pair is not null").select("pair.*")
    counts = long.distinct().groupBy("place").agg(F.count("*").alias("cardinality"))
    return counts.select(F.element_at(F.array(*[F.lit(c) for c in df.columns]), F.col("place") + 1).alias("column_name"), "cardinality")


def exact_percentiles(df: DataFrame, columns: list[str], shares: Sequence[float]) -> DataFrame:
    """(column_name, p0, p1, …): for each share the least value that at least this share of the column's values do not exceed.

    A sketch gives bounds on both sides of each percentile, wider than its error; rows below are only counted, and values
    between them, about ``2 * MARGIN`` of all rows, are counted one by one and added up in order.
    """
    cast = {c: F.col(f"`{c}`").cast("double") for c in columns}
    bounds = [F.lit(min(1.0, max(0.0, s + side * MARGIN))) for s in shares for side in (-1, 1)]
    sketches = [F.struct(F.count(c).alias("total"), F.percentile_approx(c, F.array(*bounds), 10_000).alias("at")).alias(f"k{i}") for i, c in enumerate(cast.values())]
    summary = df.agg(*sketches).select(F.struct(*[f"k{i}" for i in range(len(columns))]).alias("summary")).scalar()
    pairs, totals = [], []
    for i, c in enumerate(cast.values()):
        known = F.col("__summary")[f"k{i}"]
        for j in range(len(shares)):
            place = F.lit(i * len(shares) + j).alias("place")
            between = F.when(c <= known["at"][2 * j + 1], F.struct(place, c.alias("value")))
            pairs.append(F.when(c < known["at"][2 * j], F.struct(place, F.lit(None).cast("double").alias("value"))).otherwise(between))
            totals.append(F.greatest(F.lit(1), F.ceil(F.lit(shares[j]) * known["total"])))
    long = df.withColumn("__summary", summary).select(F.explode(F.array(*pairs)).alias("pair")).filter("pair is not null").select("pair.*")
    counts = long.groupBy("place", "value").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("place").orderBy(F.col("value").asc_nulls_first()))
    reached = counts.withColumn("upto", upto).withColumn("__summary", summary).withColumn("wanted", F.element_at(F.array(*totals), F.col("place") + 1))
    found = reached.groupBy("place").agg(
        F.min(F.when(F.col("upto") >= F.col("wanted"), F.col("value"))).alias("value"),
        F.bool_or(F.col("value").isNull() & (F.col("upto") >= F.col("wanted"))).alias("missed"),
    )
    failed = F.raise_error(F.lit("percentile outside of the bounds of its sketch")).cast("double")
    sure = F.when(F.col("missed") | F.col("value").isNull(), failed).otherwise(F.col("value"))
    named = found.select((F.col("place") % len(shares)).alias("share"), F.element_at(F.array(*[F.lit(c) for c in columns]), F.floor(F.col("place") / len(shares)).cast("int") + 1).alias("column_name"), sure.alias("value"))
    return named.groupBy("column_name").agg(*[F.max(F.when(F.col("share") == j, F.col("value"))).alias(f"p{j}") for j in range(len(shares))])


def few_valued(df: DataFrame, columns: list[str], cardinality, few: int) -> Column:
    """Scalar subquery: names of the columns with at most ``few`` distinct values by the given aggregate."""
    row = df.agg(*[cardinality(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(columns)])
    names = F.array(*[F.when(F.col(f"c{i}") <= few, c) for i, c in enumerate(columns)])
    return row.select(F.filter(names, lambda n: n.isNotNull()).alias("names")).scalar()


def profile_stats(df: DataFrame, exact: bool = False, accuracy: int = 10_000, few: int = 20) -> DataFrame:
    """Null percent (empty text counts), cardinality, 5th and 95th percentile, frequent values of every column.

    Cardinality and percentiles are sketches of bounded size (``accuracy`` is that of the percentiles); ``exact`` counts distinct
    values and finds percentiles exactly.
    Frequent values are shown, and counted, for text columns with at most ``few`` distinct values only.
    """
    if exact:
        return _exact_stats(df, few)
    cardinality = F.approx_count_distinct
    aggregates, entries = [F.count("*").alias("total")], []
    for place, field in enumerate(df.schema.fields):
        col = F.col(f"`{field.name}`")
        aggregates += [F.count_if(is_blank(df, field.name)).alias(f"blank{place}"), cardinality(col).alias(f"card{place}")]
        low = high = F.lit(None).cast("double")
        if isinstance(field.dataType, NUMERIC):
            both = F.percentile_approx(col.cast("double"), [0.05, 0.95], accuracy)
            aggregates.append(both.alias(f"pct{place}"))
            low, high = F.col(f"pct{place}")[0], F.col(f"pct{place}")[1]
        entries.append(
            {
                "column_name": F.lit(field.name),
                "dtype": F.lit(field.dataType.simpleString()),
                "row_count": F.col("total"),
                "null_pct": F.round(F.try_divide(F.col(f"blank{place}") * F.lit(100.0), F.col("total")), 1),
                "cardinality": F.col(f"card{place}"),
                "p5": F.round(low, 2),
                "p95": F.round(high, 2),
            }
        )
    base = unpivot_rows(df.agg(*aggregates), entries)
    texts = string_columns(df)
    if not texts:
        return base.withColumn("top_values", F.lit(None).cast("string"))
    shown = value_counts(df, texts, few_valued(df, texts, cardinality, few))
    return base.join(top_values_text(shown), "column_name", "left").select(*base.columns, "top_values")


def _exact_stats(df: DataFrame, few: int) -> DataFrame:
    """The columns of ``profile_stats`` without sketches in the result."""
    aggregates, entries = [F.count("*").alias("total")], []
    for place, field in enumerate(df.schema.fields):
        aggregates.append(F.count_if(is_blank(df, field.name)).alias(f"blank{place}"))
        null_pct = F.round(F.try_divide(F.col(f"blank{place}") * F.lit(100.0), F.col("total")), 1)
        names = {"column_name": F.lit(field.name), "dtype": F.lit(field.dataType.simpleString())}
        entries.append(names | {"row_count": F.col("total"), "null_pct": null_pct})
    distinct, numbers, texts = distinct_counts(df), numeric_columns(df), string_columns(df)
    base = unpivot_rows(df.agg(*aggregates), entries).join(distinct, "column_name", "left").withColumn("cardinality", F.coalesce("cardinality", F.lit(0)))
    if numbers:
        base = base.join(exact_percentiles(df, numbers, (0.05, 0.95)), "column_name", "left")
    else:
        base = base.withColumns({c: F.lit(None).cast("double") for c in ("p0", "p1")})
    base = base.select("column_name", "dtype", "row_count", "null_pct", "cardinality", F.round("p0", 2).alias("p5"), F.round("p1", 2).alias("p95"))
    if not texts:
        return base.withColumn("top_values", F.lit(None).cast("string"))
    many = distinct.filter(F.col("cardinality") > few).agg(F.collect_list("column_name")).scalar()  # as many names as columns at most
    shown = value_counts(df, texts, F.array_except(F.array(*[F.lit(c) for c in texts]), many))
    return base.join(top_values_text(shown), "column_name", "left").select(*base.columns, "top_values")


def profile_sources(spark: SparkSession, sources: Mapping[str, str], read: Callable | None = None) -> DataFrame:
    """Profiles of several sources in one report; a source that cannot be read becomes an ``_error_`` row.

    A file may prove unreadable only while it is scanned, so each profile, a row per column, is written as it is built.
    """
    reader = read or (lambda path: spark.read.parquet(path))
    root, written, errors = scratch_path(spark, "profiles"), [], []
    for place, (label, path) in enumerate(sources.items()):
        try:
            shaped = spark.createDataFrame([], PROFILE_COLUMNS).unionByName(profile(reader(path), label), allowMissingColumns=True)
            shaped.write.parquet(f"{root}/{place}")
            written.append(f"{root}/{place}")
        except (PySparkException, Py4JJavaError) as problem:
            errors.append((label, "_error_", str(problem).splitlines()[0]))
    report = spark.read.schema(PROFILE_COLUMNS).parquet(*written) if written else spark.createDataFrame([], PROFILE_COLUMNS)
    return report.unionByName(spark.createDataFrame(errors, "source string, column_name string, error string"), allowMissingColumns=True)
