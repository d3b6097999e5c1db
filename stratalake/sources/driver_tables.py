"""The given tables in the shape of the landing files and operational logs the operators expect.

Only arithmetic that every SQL engine shares is used, so the same rows can be derived elsewhere.
Ids start at 0 in the given tables; operators that demand a positive id drop that row.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_AS_OF = "2001-08-01"
EVENTS_AS_OF = "2024-01-31"
QUERY_LOG_AS_OF = "2024-01-31 12:00:00"

# Fixed values used to spread ids over categories.
PAGES = ["/billing", "/reports", "/settings", "/dashboard", "/pricing"]
PLANS = ["Free", "Starter", "Growth", "Enterprise"]
PLAN_MRR = [0.0, 29.0, 99.0, 499.0]
AGENTS = ["insight", "quality", "schema", "contract", "anomaly"]
VENDOR_CATEGORIES = ["raw-materials", "logistics", "it services", "packaging", "office supplies", "energy"]
PAYMENT_TERMS = ["net30", "net60", "net90", "immediate"]
CURRENCIES = ["usd", " eur", "gbp ", "inr"]
LOGGED_COLUMNS = ["revenue", "order_id", "customer_key", "segment", "category", "price_tier", "dau", "total_mrr", "status", "amount"]
LOGGED_TABLES = ["fct_orders", "dim_customers", "dim_products", "fct_mrr", "fct_daily_active_users"]
LOG_PHRASES = [
    "Connection refused",
    "Table raw.x doesn't exist",
    "Authentication failed",
    "No module named foo",
    "429 rate limit",
    "Out of memory",
    "all good",
]
QUESTION_WORDS = ["data contract", "dag failed", "null rate of a column", "revenue trend", "slow query", "schema drift", "hello there"]


# Column types of the given tables, so that no file footer is read to plan a query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def pick(values: list, index: Column) -> Column:
    """Entry ``index`` (0-based) of a short fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sql_array(values: list) -> str:
    """The same list as SQL text."""
    return "array(" + ", ".join(repr(v) for v in values) + ")"


def at(day: str, *, days: Column | None = None, hours: Column | None = None, minutes: Column | None = None) -> Column:
    """A fixed moment moved by integer columns."""
    zero = F.lit(0)
    part = lambda c: zero if c is None else c.cast("int")
    return F.to_timestamp(F.lit(day)) + F.make_dt_interval(part(days), part(hours), part(minutes))


class DriverTables:
    """Lazy DataFrames over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = str(sf_dir).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.dir}/{name}.parquet")

    # ---- store -------------------------------------------------------------------------------

    @cached_property
    def raw_customers(self) -> DataFrame:
        return self.table("customer").join(self.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
            "c_custkey AS customer_id",
            "' ' || split_part(c_name, '#', 1) AS first_name",
            "split_part(c_name, '#', 2) AS last_name",
            "' ' || c_name || '@Example.com ' AS email",
            "if(c_custkey % 7 = 0, '', '+1-555-' || c_custkey) AS phone",
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'b2b' WHEN 'MACHINERY' THEN 'b2b' WHEN 'AUTOMOBILE' THEN 'VIP' "
            "WHEN 'HOUSEHOLD' THEN 'B2C' ELSE 'retail' END AS segment",
            "lower(n_name) AS country",
            "if(c_custkey % 5 = 0, '', 'City ' || c_custkey % 50) AS city",
            "timestamp'1995-01-01' + make_dt_interval(int(c_custkey % 2000)) AS created_at",
            "timestamp'1995-01-01' + make_dt_interval(int(c_custkey % 2000 + c_custkey % 365)) AS updated_at",
            "CASE WHEN c_custkey % 97 = 5 THEN '2001-01-01' WHEN c_custkey % 2 = 0 THEN '' END AS _ab_cdc_deleted_at",
            "timestamp'2001-07-30 06:00:00' + make_dt_interval(0, int(c_custkey % 24)) AS _airbyte_extracted_at",
        )

    @cached_property
    def raw_orders(self) -> DataFrame:
        lines = self.table("lineitem").groupBy("l_orderkey").agg(
            F.min("l_partkey").alias("product_id"), F.count("*").cast("int").alias("quantity")
        )
        return self.table("orders").join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "product_id",
            "o_totalprice AS amount",
            "quantity",
            "CASE WHEN o_orderkey % 50 = 3 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'COMPLETED' "
            "WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'Cancelled' END AS status",
            "timestamp(o_orderdate) AS order_date",
            "timestamp(o_orderdate) + make_dt_interval(0, int(o_orderkey % 48)) AS updated_at",
            "if(o_orderkey % 89 = 4, '2001-01-01', NULL) AS _ab_cdc_deleted_at",
            "timestamp'2001-07-30 06:00:00' + make_dt_interval(0, int(o_orderkey % 24)) AS _airbyte_extracted_at",
        )

    @cached_property
    def raw_products(self) -> DataFrame:
        return self.table("part").selectExpr(
            "p_partkey AS product_id",
            "' ' || p_name AS name",
            "lower(p_type) || '-line' AS category",
            "round(p_retailprice * p_size / 50, 2) AS price",
            "p_partkey % 100 - 2 AS stock_qty",
            "' ' || lower(p_brand) || '-' || p_partkey AS sku",
            "timestamp'1995-01-01' + make_dt_interval(int(p_partkey % 300)) AS created_at",
            "timestamp'1995-01-01' + make_dt_interval(int(p_partkey % 300 + p_partkey % 1000)) AS updated_at",
            "if(p_partkey % 101 = 7, '2001-01-01', NULL) AS _ab_cdc_deleted_at",
            "timestamp'2001-07-30 06:00:00' + make_dt_interval(0, int(p_partkey % 24)) AS _airbyte_extracted_at",
        )

    @cached_property
    def raw_vendors(self) -> DataFrame:
        joined = self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        created = "date_format(timestamp'1995-01-01' + make_dt_interval(int(s_suppkey % 1000)), \"yyyy-MM-dd'T'HH:mm:ss\")"
        return joined.select("*", pick(VENDOR_CATEGORIES, F.col("s_suppkey") % 6).alias("category")).selectExpr(
            "'V' || s_suppkey AS vendor_id",
            "s_name || ' ' AS name",
            "' Contact ' || s_suppkey AS contact_name",
            "'Vendor' || s_suppkey || '@Example.com' AS email",
            "if(s_suppkey % 6 = 0, '', '+49-' || s_suppkey) AS phone",
            "lower(n_name) AS country",
            "if(s_suppkey % 4 = 0, '', 'Town ' || s_suppkey % 30) AS city",
            "category",
            f"element_at({sql_array(PAYMENT_TERMS)}, int(s_suppkey % 4 + 1)) AS payment_terms",
            "s_suppkey % 10 <> 0 AS is_active",
            f"{created} AS created_at",
            f"if(s_suppkey % 9 = 0, 'not a date', {created}) AS updated_at",
        )

    @cached_property
    def raw_purchase_orders(self) -> DataFrame:
        moment = F.col("l_shipdate").cast("timestamp")
        return self.table("lineitem").withColumn("shipped", moment).selectExpr(
            "l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || unix_date(date(l_shipdate)) AS po_id",
            "'V' || l_suppkey AS vendor_id",
            "l_extendedprice AS amount",
            f"element_at({sql_array(CURRENCIES)}, int(l_linenumber % 4 + 1)) AS currency",
            "CASE l_returnflag WHEN 'R' THEN 'received' WHEN 'A' THEN 'approved' ELSE 'Backlog' END AS status",
            "int(l_quantity) AS line_items",
            "' PO line ' || l_linenumber AS description",
            "'buyer_' || l_partkey % 20 AS requested_by",
            "shipped AS po_date",
            "shipped + make_dt_interval(int((l_partkey + 13 * l_linenumber) % 60)) AS delivery_date",
            "date_format(shipped, \"yyyy-MM-dd'T'HH:mm:ss\") AS created_at",
            "shipped + make_dt_interval(0, l_linenumber) AS updated_at",
        )

    @cached_property
    def raw_rest_users(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.table("customer").select(
            key.alias("id"),
            F.col("c_name").alias("name"),
            F.concat("c_name", F.lit("@Rest.example.com")).alias("email"),
            F.concat(F.lit("user"), key.cast("string")).alias("username"),
            F.concat(F.lit("+1-"), key.cast("string")).alias("phone"),
            F.concat(F.lit("http://example.com/"), key.cast("string")).alias("website"),
            F.struct(
                F.concat(F.lit("Street "), key.cast("string")).alias("street"),
                F.struct(F.col("c_nationkey").alias("lat")).alias("geo"),
            ).alias("address"),
            F.struct(F.col("c_mktsegment").alias("name")).alias("company"),
        )

    @cached_property
    def raw_rest_posts(self) -> DataFrame:
        key = F.col("doc_id")
        return self.table("documents").select(
            (key + 1).alias("id"),
            (key % 150 + 1).alias("userId"),
            F.concat_ws(" ", F.lit(" Review"), "source", "lang", key.cast("string")).alias("title"),
            F.col("text").alias("body"),
        )

    @cached_property
    def raw_rest_comments(self) -> DataFrame:
        conv, turn = F.col("conv_id"), F.col("turn")
        return self.table("conversations").select(
            (conv * 1000 + turn).alias("id"),
            conv.alias("postId"),
            F.col("role").alias("name"),
            F.concat(F.col("role"), conv.cast("string"), F.lit("@Example.com")).alias("email"),
            F.col("text").alias("body"),
        )

    @cached_property
    def customer_changes(self) -> DataFrame:
        """One image of the customer per order: the segment follows the order priority."""
        key = F.col("o_orderkey")
        return self.table("orders").select(
            F.col("o_custkey").alias("customer_id"),
            F.concat(F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("@example.com")).alias("email"),
            F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "VIP").otherwise("B2C").alias("segment"),
            F.when(key % 40 == 0, "MOVED").otherwise("HOME").alias("country"),
            (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (key % 1440).cast("int"))).alias(
                "updated_at"
            ),
            key.alias("lsn"),
            F.when(key % 25 == 7, "2001-01-01").alias("_ab_cdc_deleted_at"),
        )

    # ---- subscription business -----------------------------------------------------------------

    @cached_property
    def raw_saas_events(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS id",
            "user_id",
            "CASE WHEN event_type = 'view' THEN 'page_view' WHEN event_type = 'purchase' THEN 'upgrade' "
            "WHEN event_type = 'error' THEN 'payment_failed' WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'login' "
            "ELSE event_type END AS event_type",
            f"element_at({sql_array(PAGES)}, int(regexp_extract(props, '([0-9]+)', 1)) % 5 + 1) AS page",
            "props AS properties",
            "timestamp(ts) AS occurred_at",
        )

    @cached_property
    def raw_saas_users(self) -> DataFrame:
        moment = F.col("ts").cast("timestamp")
        seen = self.table("events").groupBy("user_id").agg(F.min(moment).alias("created_at"), F.max(moment).alias("updated_at"))
        return seen.selectExpr(
            "user_id AS id",
            "'customer#' || lpad(user_id * 20, 9, '0') || '@example.com' AS email",
            "'User ' || user_id AS name",
            "'Company ' || user_id % 40 AS company",
            "'NATION_' || user_id % 25 AS country",
            f"element_at({sql_array(PLANS)}, int(user_id % 4 + 1)) AS plan",
            f"double(element_at({sql_array(PLAN_MRR)}, int(user_id % 4 + 1))) AS mrr",
            "CASE user_id % 5 WHEN 0 THEN 'Churned' WHEN 1 THEN 'trial' ELSE 'active' END AS status",
            "created_at",
            "updated_at",
        )

    @cached_property
    def raw_saas_subscriptions(self) -> DataFrame:
        return self.table("events").filter("event_type = 'signup'").selectExpr(
            "event_id AS id",
            "user_id",
            f"element_at({sql_array(PLANS)}, int(event_id % 4 + 1)) AS plan",
            f"double(element_at({sql_array(PLAN_MRR)}, int(event_id % 4 + 1))) AS amount",
            "if(event_id % 2 = 1, 'annual', 'monthly') AS billing_cycle",
            "timestamp(ts) AS started_at",
            "timestamp(ts) + make_dt_interval(if(event_id % 2 = 1, 365, 30)) AS expires_at",
            "element_at(array('Active', 'cancelled', 'expired'), int(event_id % 3 + 1)) AS status",
            "timestamp(ts) AS created_at",
        )

    @cached_property
    def products_enriched(self) -> DataFrame:
        """Enrichment rows as the classifier leaves them, two versions for every third product."""
        key = F.col("p_partkey")
        price = F.round(F.col("p_retailprice") * F.col("p_size") / 50, 2)
        versions = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self.table("part").withColumn("version", F.explode(versions)).select(
            key.alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("original_category"),
            F.concat_ws("/", F.col("p_type"), F.col("p_brand")).alias("enriched_category"),
            pick(["positive", "neutral", "negative"], (key + F.col("version")) % 3).alias("sentiment"),
            F.when(price > 100, "premium").when(price < 20, "budget").otherwise("standard").alias("quality_tier"),
            F.split("p_name", " ").alias("keywords"),
            at("2001-07-31", hours=F.col("version") * 2, minutes=key % 600).alias("enriched_at"),
        )

    # ---- operational logs ----------------------------------------------------------------------

    @cached_property
    def messages(self) -> DataFrame:
        """Chat memory."""
        conv, turn = F.col("conv_id"), F.col("turn")
        return self.table("conversations").select(
            conv.cast("string").alias("session_id"),
            F.col("turn").alias("turn"),
            "role",
            F.concat_ws(" ", "text", pick(QUESTION_WORDS, (conv + turn) % 7)).alias("content"),
            pick(AGENTS, (conv + turn) % 5).alias("agent"),
            at("2024-01-01", days=conv % 30, minutes=turn).alias("created_at"),
        )

    @cached_property
    def calls(self) -> DataFrame:
        """Agent calls with their token counts."""
        conv, turn = F.col("conv_id"), F.col("turn")
        return self.table("conversations").select(
            (conv * 1000 + turn).alias("id"),
            conv.cast("string").alias("session_id"),
            pick(AGENTS, (conv + turn) % 5).alias("agent"),
            F.length("text").cast("bigint").alias("input_tokens"),
            F.size(F.split("text", " ")).cast("bigint").alias("output_tokens"),
            F.when(turn % 6 == 5, F.lit(None)).otherwise(F.length("text") % 3000).cast("bigint").alias("latency_ms"),
            at("2024-01-01", days=conv % 30, minutes=turn).alias("created_at"),
        )

    @cached_property
    def query_log(self) -> DataFrame:
        conv, turn = F.col("conv_id"), F.col("turn")
        size = F.length("text").cast("bigint")
        return self.table("conversations").select(
            (conv * 1000 + turn).alias("query_id"),
            F.concat(
                F.when((conv + turn) % 13 == 0, "INSERT INTO raw.t ").otherwise(""),
                F.lit("SELECT "),
                pick(LOGGED_COLUMNS, (conv * 3 + turn) % 10),
                F.lit(" FROM gold."),
                pick(LOGGED_TABLES, (conv + turn) % 5),
                F.lit(" -- "),
                F.col("text"),
            ).alias("query"),
            F.when((conv + turn) % 11 == 0, "ExceptionWhileProcessing").otherwise("QueryFinish").alias("type"),
            F.when((conv + turn) % 13 == 0, "Insert").otherwise("Select").alias("query_kind"),
            at("2024-01-30", minutes=(conv * 7 + turn * 31) % 2880).alias("event_time"),
            (size * 3 % 5000).alias("query_duration_ms"),
            (size * 100).alias("read_rows"),
            (size * 4096).alias("read_bytes"),
            (size * size * 1024).alias("memory_usage"),
            (turn % 2).cast("int").alias("is_initial_query"),
        )

    @cached_property
    def runs(self) -> DataFrame:
        """Run history: one run per event; the event value is the duration in minutes."""
        started = F.col("ts").cast("timestamp")
        seconds = F.floor(F.col("value") * 60).cast("bigint")
        return self.table("events").select(
            F.concat(F.lit("dag_"), (F.col("user_id") % 7).cast("string")).alias("dag_id"),
            F.concat(F.lit("run_"), F.col("event_id").cast("string")).alias("dag_run_id"),
            F.when(F.col("event_type") == "error", "failed")
            .when(F.col("event_type") == "click", "running")
            .otherwise("success")
            .alias("state"),
            started.alias("start_date"),
            F.when(F.col("event_type") != "click", F.timestamp_add("SECOND", seconds, started)).alias("end_date"),
        )

    @cached_property
    def task_tries(self) -> DataFrame:
        """Task attempts: a run per user and day, a task per event kind."""
        ts = F.col("ts").cast("timestamp")
        return self.table("events").select(
            F.concat_ws("_", F.lit("run"), F.col("user_id"), F.date_format(ts, "yyyyMMdd")).alias("run_id"),
            F.concat(F.lit("task_"), (F.col("event_id") % 2).cast("string")).alias("task_id"),
            F.when(F.col("event_type").isin("error", "click", "view"), "failed").otherwise("success").alias("state"),
            ts.alias("started_at"),
        )

    @cached_property
    def connections(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("connection_id"), F.col("n_name").alias("name"))

    @cached_property
    def jobs(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").select(
            F.col("event_id").alias("job_id"),
            (F.col("user_id") % 20).cast("int").alias("connection_id"),
            F.when(kind == "error", "failed").when(kind == "click", "running").otherwise("succeeded").alias("status"),
            F.col("ts").cast("timestamp").alias("started_at"),
        )

    @cached_property
    def task_logs(self) -> DataFrame:
        """Log text: the page of a conversation turn with a phrase of the service in its last lines."""
        conv, turn = F.col("conv_id"), F.col("turn")
        return self.table("conversations").select(
            (conv * 1000 + turn).alias("log_id"),
            F.concat(
                F.col("text"),
                F.lit("\nERROR step "),
                turn.cast("string"),
                F.lit("\nException: "),
                pick(LOG_PHRASES, (conv + turn) % 7),
                F.lit("\nleaving"),
            ).alias("log"),
        )

    @cached_property
    def incidents(self) -> DataFrame:
        """Incidents of the service: error events; low ones resolve themselves."""
        low = F.col("value") < 50
        return self.table("events").filter(F.col("event_type") == "error").select(
            F.col("event_id").alias("id"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("entity"),
            F.concat(F.lit("error "), F.get_json_object("props", "$.k")).alias("problem"),
            F.when(low, F.lit("retried")).alias("action_taken"),
            F.coalesce(low, F.lit(False)).alias("resolved"),
            F.col("ts").alias("created_at"),
        )

    @cached_property
    def table_counts(self) -> DataFrame:
        """Row counts per run date and table: the events of each kind per day."""
        return (
            self.table("events")
            .groupBy(F.to_date("ts").alias("run_date"), F.col("event_type").alias("table_name"))
            .agg(F.count("*").alias("row_count"))
            .withColumn("pipeline", F.lit("saas"))
        )

    @cached_property
    def test_results(self) -> DataFrame:
        """One JSON document per event holding two test results."""
        states = ["pass", "success", "warn", "error", "fail", "skipped"]
        key = F.col("event_id")
        return self.table("events").select(
            key.alias("doc_id"),
            F.to_date("ts").alias("run_date"),
            F.format_string(
                '{"results":[{"status":"%s"},{"status":"%s"}]}', pick(states, key % 6), pick(states, key % 5)
            ).alias("json"),
        )

    @cached_property
    def cdc_messages(self) -> DataFrame:
        """Product change messages in arrival order; odd products are wrapped in a payload, every third has two images.

        Some products send a message that holds no row: broken text, an empty object or payload, an object without id.
        """
        key = F.col("p_partkey")
        versions = F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        price = F.round(F.col("p_retailprice") * F.col("p_size") / 50, 2)
        rows = self.table("part").withColumn("version", F.explode(versions)).select(
            key.alias("product_id"),
            "version",
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            (price + F.col("version")).alias("price"),
        )
        body = F.struct("product_id", "name", "category", "price")
        text = F.when(key_is_odd(), F.to_json(F.struct(F.lit("row").alias("schema"), body.alias("payload")))).otherwise(
            F.to_json(body)
        )
        whole = rows.select((F.col("product_id") * 2 + F.col("version")).alias("offset"), text.alias("value"))
        value = reduce(lambda c, kv: c.when(key % 30 == kv[0], kv[1]), BROKEN_MESSAGES.items(), F.when(F.lit(False), ""))
        broken = self.table("part").select((key * 2 + 1).alias("offset"), value.alias("value")).filter(F.col("value").isNotNull())
        return whole.unionByName(broken)


#: By the remainder of the product's id; none is divisible by three, so their second offset is free.
BROKEN_MESSAGES = {1: "{}", 2: '{"payload": null}', 4: '{"product_id": 1', 5: "{broken}", 7: "", 8: '{"name": "no id"}', 10: "[1]", 11: '{"payload": {}}'}


def key_is_odd() -> Column:
    return F.col("product_id") % 2 == 1
