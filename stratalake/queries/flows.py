"""Landing, sinks, incremental tables, streams. Sinks and streams write below the shared scratch folder and are read back."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators import incremental as inc
from stratalake.operators import quality
from stratalake.operators.dedup import dedup_latest
from stratalake.plans import gold, loads, marts, silver
from stratalake.queries.registry import query
from stratalake.session import scratch_path
from stratalake.sources import bucketed, curve, files, landing, sinks, versioned
from stratalake.sources.driver_tables import BROKEN_MESSAGES, EVENTS_AS_OF, ORDERS_AS_OF, SCHEMAS, DriverTables
from stratalake.streaming import cdc, enrichment, events, sketches

ENRICHED_AT = "2001-08-01 00:00:00"

# ---- sources -----------------------------------------------------------------------------------------


def _scan(t):
    """The orders landed in several files of one prefix, scanned again."""
    path = scratch_path(t.spark, "prefix")
    t.table("orders").repartition(4, "o_orderkey").write.parquet(path)
    return files.scan_prefix(t.spark, path, t.table("orders").schema)


query("src9_scan_prefix", "SELECT * FROM orders")(_scan)
query(
    "src12_incremental_since",
    "SELECT order_id, customer_id, updated_at FROM raw_orders WHERE updated_at > TIMESTAMP '2001-07-01'",
)(lambda t: landing.incremental_since(t.raw_orders, "2001-07-01").select("order_id", "customer_id", "updated_at"))
query("src12_next_cursor", "SELECT max(updated_at) AS next_cursor FROM raw_orders")(lambda t: landing.next_cursor(t.raw_orders))
query("src13_extract_limited", "SELECT * FROM customer ORDER BY c_custkey LIMIT 500")(
    lambda t: landing.extract_limited(t.table("customer"), "c_custkey", 500)
)
query(
    "src14_null_defaults",
    """SELECT order_id, coalesce(product_id, 0) AS product_id, coalesce(quantity, 0) AS quantity,
      coalesce(_ab_cdc_deleted_at, '') AS _ab_cdc_deleted_at FROM raw_orders""",
)(
    lambda t: landing.null_defaults(
        t.raw_orders.select("order_id", "product_id", "quantity", "_ab_cdc_deleted_at"),
        {"product_id": 0, "quantity": 0, "_ab_cdc_deleted_at": ""},
    )
)
query(
    "src15_load_metadata",
    """SELECT s_suppkey, s_name, CAST(NULL AS VARCHAR) AS _ab_cdc_deleted_at, CAST(NULL AS VARCHAR) AS _ab_cdc_lsn,
      TIMESTAMP '2001-08-01' AS _airbyte_extracted_at, 'sync-1' AS _airbyte_sync_id FROM supplier""",
)(lambda t: landing.with_load_metadata(t.table("supplier").select("s_suppkey", "s_name"), ORDERS_AS_OF, "sync-1"))
query(
    "src16_flatten_nested",
    """SELECT c_custkey AS id, '{"street":"Street ' || c_custkey || '","geo":{"lat":' || c_nationkey || '}}' AS address,
      '{"name":"' || c_mktsegment || '"}' AS company, strftime(TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 2000 AS INT)),
      '%Y-%m-%dT%H:%M:%S') AS created_at FROM customer""",
)(
    lambda t: landing.flatten_nested(
        t.raw_rest_users.select("id", "address", "company").join(
            t.raw_customers.select(F.col("customer_id").alias("id"), "created_at"), "id"
        )
    )
)


REQUIRED = ["customer", "orders", "part", "supplier", "shipments"]
GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table_files(t) -> DataFrame:
    """Every file below the input folder, also one without rows, with the number of rows read from it; a table is a prefix."""
    place = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    listing = files.file_listing(t.spark, t.dir).withColumn("path", place("path")).withColumn("prefix", F.regexp_extract("path", r"([^/]+)\.parquet(?:/.*)?$", 1))
    counts = files.rows_by_file(t.spark, t.dir).withColumn("path", place("path"))
    return listing.join(counts, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0).cast("long")))


query(
    "src17_require_sources",
    " UNION ALL ".join(f"SELECT '{n}' AS prefix, CAST(least(count(*), 1) AS INT) AS files, count(*) > 0 AS present FROM {n}" for n in REQUIRED[:-1])
    + " UNION ALL SELECT 'shipments', 0, false",
)(lambda t: files.require_sources(table_files(t), REQUIRED).withColumn("files", F.col("files").cast("int")))


def _src18(t):
    """Ages are counted from the newest file."""
    listing = table_files(t)
    newest = listing.agg(F.max("modificationTime").alias("newest")).scalar()
    rows = listing.groupBy("prefix").agg(F.sum("rows").alias("rows"))
    return files.file_inventory(listing, newest).join(rows, "prefix")


query("src18_file_inventory")(_src18)
query("src18_rows_by_prefix", " UNION ALL ".join(f"SELECT '{n}' AS prefix, count(*) AS rows FROM {n}" for n in GIVEN))(
    lambda t: table_files(t).groupBy("prefix").agg(F.sum("rows").alias("rows"))
)

# ---- sinks -------------------------------------------------------------------------------------------

ORDERS = "SELECT * FROM orders"


def _snk1(t):
    root = scratch_path(t.spark, "snapshots")
    return sinks.read_back(t.spark, sinks.write_snapshot(t.unified, root, ORDERS_AS_OF))


query("snk1_write_snapshot", "SELECT * FROM unified")(_snk1)


def _external_table(t, df: DataFrame, name: str) -> str:
    """A uniquely named table whose files are in the scratch folder."""
    path = scratch_path(t.spark, name)
    return sinks.materialize_table(df, "t_" + path.rsplit("-", 1)[1], path)


def _snk2(t):
    table = _external_table(t, t.table("supplier").limit(0), "replaced")
    sinks.replace_table(t.table("supplier"), table)
    sinks.replace_table(t.table("supplier"), table)
    return t.spark.table(table)


query("snk2_replace_table", "SELECT * FROM supplier")(_snk2)


def _snk3(t):
    path = scratch_path(t.spark, "landed")
    for _ in range(2):
        sinks.land_idempotent(t.table("orders"), path)
    return sinks.read_back(t.spark, path)


query("snk3_land_idempotent", ORDERS)(_snk3)
query("snk4_materialize_table", "SELECT * FROM stg_vendors")(lambda t: t.spark.table(_external_table(t, t.stg_vendors, "vendors")))


def _snk5(t):
    path = scratch_path(t.spark, "runs")
    cut = F.col("o_orderdate") < "1998-01-01"
    sinks.land_append(t.table("orders").filter(cut), path, 1)
    sinks.land_append(t.table("orders").filter(~cut), path, 2)
    sinks.land_append(t.table("orders").filter(~cut), path, 2)
    return sinks.read_back(t.spark, path).drop("run")


query("snk5_land_append", ORDERS)(_snk5)


def _snk6(t):
    path = scratch_path(t.spark, "tsv")
    shaped = t.table("documents").select("doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("lang")).alias("lang"), "text")
    sinks.write_tsv(shaped, path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


query(
    "snk6_write_tsv",
    r"""SELECT doc_id || chr(9) || CASE WHEN doc_id % 5 <> 0 THEN lang ELSE '\N' END || chr(9) ||
      replace(replace(text, chr(9), ' '), chr(10), ' ') AS line FROM documents""",
)(_snk6)


def _snk7(t):
    first, second = scratch_path(t.spark, "first"), scratch_path(t.spark, "second")
    sinks.multi_sink(t.dim_users, first, [lambda df: df.write.parquet(second)])
    both = sinks.read_back(t.spark, first).withColumn("sink", F.lit("first"))
    return both.unionByName(sinks.read_back(t.spark, second).withColumn("sink", F.lit("second")))


query("snk7_multi_sink", "SELECT *, 'first' AS sink FROM dim_users UNION ALL SELECT *, 'second' FROM dim_users")(_snk7)


def _snk8(t):
    path = scratch_path(t.spark, "clustered")
    sinks.write_clustered(t.fct_orders.select("order_id", "order_date_day", "order_month", "revenue"), path, ["order_date_day", "order_id"], "order_month")
    return sinks.read_back(t.spark, path)


query("snk8_write_clustered", "SELECT order_id, order_date_day, order_month, CAST(revenue AS DOUBLE) AS revenue FROM fct_orders")(_snk8)

CURVE = {"ship_date": ("1998-01-01", "1998-03-31"), "l_quantity": (20.0, 22.0), "l_extendedprice": (40_000.0, 45_000.0)}


def _snk8_curve(t):
    """One range of each of three keys from one layout: rows, their quantity, and whether at most half of the folders are read."""
    rows = t.table("lineitem").select(F.col("l_shipdate").cast("date").alias("ship_date"), "l_quantity", "l_extendedprice")
    path, keys = curve.write_curve(rows, scratch_path(t.spark, "curve"), list(CURVE)), list(CURVE)
    parts = []
    for key, (low, high) in CURVE.items():
        ends = tuple(F.lit(e).cast(rows.schema[key].dataType) for e in (low, high))
        found = curve.read_range(t.spark, path, rows.schema, keys, {key: ends})
        touched = curve.touched_parts(t.spark, path, keys, {key: ends}).agg((F.count("*") <= curve.PARTS / 2).alias("few")).scalar()
        parts.append(found.agg(F.lit(key).alias("key"), F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity")).withColumn("few_folders", touched))
    return quality.union_all(parts)


query(
    "snk8_curve_ranges",
    " UNION ALL ".join(
        f"""SELECT '{key}' AS key, count(*) AS rows, sum(l_quantity) AS quantity, true AS few_folders FROM lineitem
          WHERE {'CAST(l_shipdate AS DATE)' if key == 'ship_date' else key} BETWEEN '{low}' AND '{high}'"""
        for key, (low, high) in CURVE.items()
    ),
)(_snk8_curve)

# ---- incremental -------------------------------------------------------------------------------------

CUT = "2000-01-01"
LATER = "2000-06-01"
KEEP = ["order_id", "customer_id", "status", "updated_at"]


def _halves(t):
    """Target as loaded up to a day, and the source as it is now with later status values."""
    rows = t.bronze_orders.select(*KEEP)
    target = rows.filter(F.col("updated_at") < CUT).withColumn("status", F.lit("old"))
    return target, rows


def _upsert_sql(floor: str, compare: str) -> str:
    return f""", target AS (SELECT order_id, customer_id, 'old' AS status, updated_at FROM bronze_orders WHERE updated_at < TIMESTAMP '{CUT}'),
      fresh AS (SELECT order_id, customer_id, status, updated_at FROM bronze_orders
        WHERE updated_at {compare} (SELECT {floor} - INTERVAL 1 HOUR FROM target))
      SELECT * FROM target WHERE order_id NOT IN (SELECT order_id FROM fresh) UNION ALL SELECT * FROM fresh"""


query("inc1_incremental_upsert", _upsert_sql("date_trunc('hour', max(updated_at))", ">="))(
    lambda t: inc.incremental_upsert(*_halves(t), ["order_id"], "updated_at")
)


def _versioned(t):
    """The same upsert by writing only the new rows, twice, next to the target."""
    target, source = _halves(t)
    path = scratch_path(t.spark, "versioned")
    versioned.write_batch(target, path, 0)
    stored = t.spark.read.schema(target.schema).parquet(f"{path}/{versioned.BATCH}=0")
    fresh = inc.new_rows(source, stored, "updated_at")
    for _ in range(2):
        versioned.write_batch(fresh, path, 1)
    return versioned.read_target(t.spark, path, ["order_id"], "updated_at")


# Models built into a stored target up to a moment, then loaded with the rest, in two loads of which the first is repeated.
MODELS = {
    "sil1_incremental": (lambda t, rows: silver.stg_customers(rows, ORDERS_AS_OF), "bronze_customers", "customer_id", "updated_at"),
    "sil2_incremental": (lambda t, rows: silver.stg_orders(rows), "bronze_orders", "order_id", "updated_at"),
    "sil4_incremental": (lambda t, rows: silver.stg_purchase_orders(rows), "bronze_purchase_orders", "po_id", "updated_at"),
    "sil7_incremental": (lambda t, rows: silver.stg_events(rows), "raw_saas_events", "event_id", "occurred_at"),
    "fct1_incremental": (lambda t, rows: gold.fct_orders(rows, t.dim_customers, t.dim_products), "stg_orders", "order_id", "updated_at"),
    "fct2_incremental": (lambda t, rows: gold.fct_procurement(rows, t.dim_vendors), "stg_purchase_orders", "po_id", "updated_at"),
}


def _incremental(name):
    make, source, key, ts = MODELS[name]

    def run(t):
        stored = t.with_dimensions(*{"fct1_incremental": ["dim_products", "dim_customers"], "fct2_incremental": ["dim_vendors"]}.get(name, []))
        rows, path = getattr(t, source), scratch_path(t.spark, name)
        model = lambda part: make(stored, part)
        early, middle = (F.col(ts) < F.lit(m).cast("timestamp") for m in (("2024-01-15", "2024-01-25") if ts == "occurred_at" else (CUT, LATER)))
        loads.build_model(model, rows.filter(early), path)
        for batch in (1, 1):
            loads.load_model(model, rows.filter(middle), path, ts, batch)
        loads.load_model(model, rows, path, ts, 2)
        return loads.read_model(rows, path, [key], ts)

    return run


MONEY = {"sil2_incremental": ("amount", "revenue"), "sil4_incremental": ("amount", "fulfilled_amount")}
MONEY |= {"fct1_incremental": MONEY["sil2_incremental"], "fct2_incremental": MONEY["sil4_incremental"]}
FULL = {
    "sil1_incremental": "stg_customers", "sil2_incremental": "stg_orders", "sil4_incremental": "stg_purchase_orders", "sil7_incremental": "stg_events",
    "fct1_incremental": "fct_orders", "fct2_incremental": "fct_procurement",
}
for _name, _full in FULL.items():
    _shown = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY.get(_name, ()))
    query(_name, f"SELECT * {f'REPLACE ({_shown})' if _shown else ''} FROM {_full}")(_incremental(_name))


def _fct5_target(t):
    """The mart as of some moment, merged with the rows that came since."""
    raw, moment = t.products_enriched, F.lit("2001-07-31 05:00:00").cast("timestamp")
    mart = enrichment.mart_product_enrichment(raw.filter(F.col("enriched_at") < moment))
    return enrichment.mart_product_enrichment(raw, mart)


query("fct5_with_target", "SELECT * FROM mart_enrichment")(_fct5_target)
query("inc1_versioned_table", _upsert_sql("date_trunc('hour', max(updated_at))", ">="))(_versioned)


def _bucketed(t, first, changes, keys, combine):
    """A bucketed table of ``first``, the changes merged twice under one batch id, read back."""
    path = scratch_path(t.spark, "bucketed")
    bucketed.create(first, path, keys)
    for _ in range(2):
        bucketed.merge(changes, path, first, keys, combine, 1)
    return bucketed.read(t.spark, path, first, keys)


def _bucket_upsert(t):
    target, source = _halves(t)
    return _bucketed(t, target, inc.new_rows(source, target, "updated_at"), ["order_id"], lambda old, new: inc.delete_insert(old, new, ["order_id"]))


query("inc1_bucket_merge", _upsert_sql("date_trunc('hour', max(updated_at))", ">="))(_bucket_upsert)
query("inc2_plain_lookback", _upsert_sql("max(updated_at)", ">="))(
    lambda t: inc.incremental_upsert(*_halves(t), ["order_id"], "updated_at", floor=None)
)
query("inc1_strict_lookback", _upsert_sql("max(updated_at)", ">"))(
    lambda t: inc.incremental_upsert(*_halves(t), ["order_id"], "updated_at", floor=None, strict=True)
)
query("set2_union_kept_and_new", _upsert_sql("date_trunc('hour', max(updated_at))", ">="))(
    lambda t: inc.incremental_upsert(*_halves(t), ["order_id"], "updated_at", dedupe=["updated_at"])
)


def _inc3(t):
    """Daily actives with stale counts up to a day, brought up to date by aggregating only the last days again."""
    stale = marts.fct_daily_active_users(t.stg_events.filter(F.col("event_date") <= "2024-01-20")).withColumn("dau", F.lit(0).cast("bigint"))
    return inc.reaggregate_recent(stale, t.stg_events, "event_date", marts.fct_daily_active_users, days=3)


query(
    "inc3_reaggregate_recent",
    "SELECT * REPLACE (CASE WHEN event_date < DATE '2024-01-17' THEN 0 ELSE dau END AS dau) FROM fct_dau",
)(_inc3)
query("inc4_full_refresh", "SELECT order_id, customer_id, status, updated_at FROM bronze_orders")(
    lambda t: inc.incremental_upsert(*_halves(t), ["order_id"], "updated_at", full_refresh=True)
)


def _inc5(t):
    changes = t.customer_changes
    target = dedup_latest(changes.filter(F.col("updated_at") < CUT), ["customer_id"], ["updated_at", "lsn"])
    return inc.append_dedup(target, changes.filter(F.col("updated_at") >= CUT), ["customer_id"], "updated_at", "lsn")


query(
    "inc5_append_dedup",
    "SELECT * FROM customer_changes QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, lsn DESC) = 1",
)(_inc5)


def _inc6(t):
    base = t.customer_changes.filter(F.col("updated_at") < CUT)
    target = dedup_latest(base, ["customer_id"], ["updated_at", "lsn"]).select("customer_id", "segment", "updated_at")
    changes = t.customer_changes.filter(F.col("updated_at") >= CUT)
    return inc.apply_cdc(target, changes, ["customer_id"], ["updated_at", "lsn"], "_ab_cdc_deleted_at")


APPLIED = (
    f""", ranked AS (SELECT *, row_number() OVER (PARTITION BY customer_id, updated_at >= TIMESTAMP '{CUT}'
        ORDER BY updated_at DESC, lsn DESC) AS rn FROM customer_changes),
      fresh AS (SELECT * FROM ranked WHERE rn = 1 AND updated_at >= TIMESTAMP '{CUT}')
      SELECT customer_id, segment, updated_at FROM ranked WHERE rn = 1 AND updated_at < TIMESTAMP '{CUT}'
        AND customer_id NOT IN (SELECT customer_id FROM fresh)
      UNION ALL SELECT customer_id, segment, updated_at FROM fresh WHERE _ab_cdc_deleted_at IS NULL"""
)
query("inc6_apply_cdc", APPLIED)(_inc6)


def _inc6_buckets(t):
    """The same images on a bucketed table."""
    columns = ["customer_id", "segment", "updated_at"]
    target = dedup_latest(t.customer_changes.filter(F.col("updated_at") < CUT), ["customer_id"], ["updated_at", "lsn"]).select(*columns)
    changes = t.customer_changes.filter(F.col("updated_at") >= CUT)
    return _bucketed(t, target, changes, ["customer_id"], lambda old, new: inc.apply_cdc(old, new, ["customer_id"], ["updated_at", "lsn"], "_ab_cdc_deleted_at"))


query("inc6_bucket_cdc", APPLIED)(_inc6_buckets)
query(
    "inc7_retention",
    """SELECT 'facts' AS kind, order_id FROM fct_orders WHERE order_date > TIMESTAMP '2001-08-01' - INTERVAL 365 DAY
      UNION ALL SELECT 'staging', order_id FROM stg_orders WHERE updated_at > TIMESTAMP '2001-08-01' - INTERVAL 90 DAY""",
)(
    lambda t: inc.apply_retention(t.fct_orders, "order_date", 365, ORDERS_AS_OF)
    .select(F.lit("facts").alias("kind"), "order_id")
    .unionByName(inc.apply_retention(t.stg_orders, "updated_at", 90, ORDERS_AS_OF).select(F.lit("staging").alias("kind"), "order_id"))
)


def _inc8(t):
    """One day of a daily table replaced twice, on disk, partition by partition."""
    path = scratch_path(t.spark, "daily")
    counts = t.table_counts
    inc.overwrite_days(counts.withColumn("row_count", F.lit(0).cast("bigint")), path, "run_date")
    for _ in range(2):
        inc.overwrite_days(counts.filter(F.col("run_date") == "2024-01-30"), path, "run_date")
    return t.spark.read.schema(counts.schema).parquet(path)


query(
    "inc8_replace_day",
    "SELECT * REPLACE (CASE WHEN run_date = DATE '2024-01-30' THEN row_count ELSE 0 END AS row_count) FROM table_counts",
)(_inc8)
query("inc9_purge_sessions", "SELECT * FROM messages WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 15 DAY")(
    lambda t: inc.purge_older_than(t.messages, "created_at", 15, EVENTS_AS_OF)
)

# ---- streams -----------------------------------------------------------------------------------------


def land_messages(t: DriverTables, parts: int = 4) -> str:
    """Change messages landed as files in offset order."""
    path = scratch_path(t.spark, "messages")
    t.cdc_messages.repartitionByRange(parts, "offset").write.parquet(path)
    return path


def land_events(t, copies: int = 1) -> str:
    path = scratch_path(t.spark, "events")
    rows = t.table("events").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    rows.repartitionByRange(4, "ts").drop("copy").write.parquet(path)
    return path


def event_stream(t, path: str) -> DataFrame:
    raw = t.spark.readStream.schema(SCHEMAS["events"]).parquet(path)
    return raw.withColumn("occurred_at", F.col("ts").cast("timestamp"))


def run_stream(t, stream: DataFrame, prepare=None, after=None, mode: str = "append") -> str:
    """Run to the end into a fresh versioned target; returns its path."""
    target = scratch_path(t.spark, "target")
    cdc.run_available(stream, cdc.foreach_batch_upsert(target, prepare, after), scratch_path(t.spark, "checkpoint"), mode)
    return target


MESSAGES = """, msg AS (SELECT p_partkey * 2 + v AS "offset", p_partkey AS product_id, p_name AS name, p_type AS category,
  round(p_retailprice * p_size / 50, 2) + v AS price FROM part JOIN (VALUES (0), (1)) x(v) ON v = 0 OR p_partkey % 3 = 0)"""
ALL_MESSAGES = "WITH " + MESSAGES[2:]
LAST = "SELECT * FROM msg QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY \"offset\" DESC) = 1"
TIER = "CASE WHEN price > 100 THEN 'premium' WHEN price < 20 THEN 'budget' ELSE 'standard' END"
ENRICHED_SQL = f"""{ALL_MESSAGES} SELECT product_id, name AS product_name, category AS original_category, category AS enriched_category,
  'neutral' AS sentiment, {TIER} AS quality_tier, '' AS keywords, TIMESTAMP '{ENRICHED_AT}' AS enriched_at FROM ({LAST})"""


def _source(t, per_trigger: int | None = None) -> cdc.StreamSource:
    return cdc.StreamSource(path=land_messages(t), per_trigger=per_trigger)


def _str1(t):
    stream = cdc.cdc_stream(t.spark, _source(t))
    return t.spark.read.parquet(run_stream(t, stream.select("offset"))).drop(cdc.BATCH)


# Every landed message is read; those that hold no row are skipped later.
LANDED = f"""(SELECT "offset" FROM msg UNION ALL
  SELECT CAST(p_partkey * 2 + 1 AS BIGINT) FROM part WHERE p_partkey % 30 IN ({", ".join(map(str, BROKEN_MESSAGES))}))"""
query("str1_cdc_stream", f'{ALL_MESSAGES} SELECT "offset" FROM {LANDED}')(_str1)


def _str2(t):
    rows = cdc.unwrap_cdc(cdc.cdc_stream(t.spark, _source(t)))
    return t.spark.read.parquet(run_stream(t, rows)).drop(cdc.BATCH)


query("str2_unwrap_cdc", ALL_MESSAGES + " SELECT * FROM msg")(_str2)


def _str3(t):
    """One file per micro-batch until everything is read: the number of batches and rows."""
    target = run_stream(t, cdc.cdc_stream(t.spark, _source(t, per_trigger=1)))
    return t.spark.read.parquet(target).agg(
        F.count_distinct(cdc.BATCH).cast("int").alias("batches"), F.count("*").alias("rows_read")
    )


query("str3_run_available", f"{ALL_MESSAGES} SELECT CAST(4 AS INT) AS batches, count(*) AS rows_read FROM {LANDED}")(_str3)


def _str4(t):
    """The long-running form, stopped once the landed messages are through."""
    target = scratch_path(t.spark, "target")
    rows = cdc.unwrap_cdc(cdc.cdc_stream(t.spark, _source(t)))
    running = cdc.run_continuous(rows, cdc.foreach_batch_upsert(target), scratch_path(t.spark, "checkpoint"), "1 second")
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return t.spark.read.parquet(target).drop(cdc.BATCH)


query("str4_run_continuous", ALL_MESSAGES + " SELECT * FROM msg")(_str4)


def classify_by_name(products: pd.DataFrame) -> pd.DataFrame:
    """Stand-in for an external classifier; it refuses batches that hold an expensive product."""
    names, prices = products["name"].tolist(), products["price"].tolist()
    if any(p > 1800 for p in prices):
        raise RuntimeError("classifier unavailable")
    return pd.DataFrame(
        {
            "product_id": products["product_id"].tolist(),
            "sentiment": ["positive" if n.startswith("s") else "neutral" for n in names],
            "quality_tier": ["premium" if p > 100 else "standard" for p in prices],
            "enriched_category": [c if pd.isna(c) else c.lower() for c in products["category"].tolist()],
            "keywords": [n.split(" ") for n in names],
        }
    )


def _str5(t):
    """Classification one product at a time, so that a refusal concerns that product only."""
    rows = cdc.latest_in_batch(cdc.unwrap_cdc(t.cdc_messages))
    return enrichment.enrich_products(rows, classify_by_name, batch_size=1, tasks=2 * t.spark.sparkContext.defaultParallelism)


query(
    "str5_enrich_products",
    f"""{ALL_MESSAGES} SELECT product_id,
      CASE WHEN price <= 1800 AND name LIKE 's%' THEN 'positive' ELSE 'neutral' END AS sentiment,
      CASE WHEN price <= 1800 AND price > 100 THEN 'premium' ELSE 'standard' END AS quality_tier,
      CASE WHEN price <= 1800 THEN lower(category) ELSE category END AS enriched_category,
      CASE WHEN price <= 1800 THEN replace(name, ' ', '|') ELSE '' END AS keywords FROM ({LAST})""",
)(_str5)
query(
    "str6_quality_tier",
    f"SELECT product_id, {TIER} AS quality_tier FROM raw_products",
)(lambda t: t.raw_products.select("product_id", enrichment.quality_tier(F.col("price")).alias("quality_tier")))


def _str7(t):
    rows = cdc.unwrap_cdc(cdc.cdc_stream(t.spark, _source(t)))
    return t.spark.read.parquet(run_stream(t, rows, prepare=cdc.latest_in_batch)).drop(cdc.BATCH)


query("str7_latest_in_batch", f"{ALL_MESSAGES} {LAST}")(_str7)


def _str8(t):
    raw = cdc.latest_in_batch(cdc.unwrap_cdc(t.cdc_messages))
    return enrichment.attach_raw(enrichment.enrich_products(raw), raw, ENRICHED_AT)


query("str8_attach_raw", ENRICHED_SQL)(_str8)


def _enrich(batch: DataFrame) -> DataFrame:
    return enrichment.enrich_messages(batch, ENRICHED_AT)


def _str9(t):
    stream = cdc.cdc_stream(t.spark, _source(t, per_trigger=2))
    return cdc.read_target(t.spark, run_stream(t, stream, prepare=_enrich), ["product_id"], "enriched_at")


query("str9_foreach_batch_upsert", ENRICHED_SQL)(_str9)


def _str10(t):
    target, mart = scratch_path(t.spark, "target"), scratch_path(t.spark, "mart")
    function = cdc.foreach_batch_upsert(target, _enrich, enrichment.refresh_mart(target, mart))
    cdc.run_available(cdc.cdc_stream(t.spark, _source(t, per_trigger=2)), function, scratch_path(t.spark, "checkpoint"))
    return cdc.read_target(t.spark, mart, ["product_id"], "enriched_at")


query("str10_refresh_if_nonempty", ENRICHED_SQL)(_str10)


def _str11(t):
    kinds = t.raw_saas_events.select("id", "event_type")
    path = scratch_path(t.spark, "typed_events")
    typed = t.table("events").drop("event_type").join(kinds, F.col("event_id") == F.col("id")).drop("id")
    typed.select(*t.table("events").columns).repartitionByRange(4, "ts").write.parquet(path)
    target = run_stream(t, events.streaming_user_days(event_stream(t, path)), mode="update")
    return events.read_dau(t.spark, target)


query("str11_streaming_dau", "SELECT * FROM fct_dau")(_str11)
ROLLED = (7, 28)
ALLOWED_ERROR = 0.03


def _str11_sketches(t):
    """Streamed day sketches, merged over 7 and 28 days, beside the exact counts: the exact count and whether the estimate is within 3%."""
    path = land_events(t, copies=1)
    target = run_stream(t, sketches.streaming_day_sketches(event_stream(t, path)), mode="update")
    days = sketches.read_day_sketches(t.spark, target)
    out = None
    for length in ROLLED:
        exact = sketches.exact_rolling_actives(t.table("events").withColumnRenamed("ts", "occurred_at"), length)
        both = exact.join(sketches.rolling_actives(days, length), "event_date", "left")
        near = F.coalesce(F.abs(F.col("actives") - F.col("exact")) <= ALLOWED_ERROR * F.col("exact"), F.lit(False))
        flagged = both.select("event_date", F.col("exact").alias(f"exact_{length}"), near.alias(f"near_{length}"))
        out = flagged if out is None else out.join(flagged, "event_date")
    return out


query(
    "str11_sketched_actives",
    """SELECT d.event_date, """
    + ", ".join(
        f"(SELECT count(DISTINCT user_id) FROM events e WHERE CAST(e.ts AS DATE) BETWEEN d.event_date - {n - 1} AND d.event_date) AS exact_{n}, true AS near_{n}" for n in ROLLED
    )
    + " FROM (SELECT DISTINCT CAST(ts AS DATE) AS event_date FROM events) d",
)(_str11_sketches)


def _str12(t):
    stream = events.streaming_dedup(event_stream(t, land_events(t, copies=2)))
    return t.spark.read.parquet(run_stream(t, stream)).drop(cdc.BATCH, "occurred_at")


query("str12_streaming_dedup", "SELECT * FROM events")(_str12)


def _str13(t):
    """The plain messages, a stop, then the wrapped ones and a restart from the same checkpoint."""
    path, target, checkpoint = (scratch_path(t.spark, n) for n in ("messages", "target", "checkpoint"))
    early = ~F.contains("value", F.lit('"payload"'))
    for part in (t.cdc_messages.filter(early), t.cdc_messages.filter(~early)):
        part.write.mode("append").parquet(path)
        stream = cdc.unwrap_cdc(cdc.cdc_stream(t.spark, cdc.StreamSource(path=path)))
        cdc.run_available(stream, cdc.foreach_batch_upsert(target), checkpoint)
    return t.spark.read.parquet(target)


query(
    "str13_resume_from_checkpoint",
    ALL_MESSAGES + ' SELECT *, CAST(product_id % 2 AS INT) AS batch_id FROM msg',
)(_str13)
