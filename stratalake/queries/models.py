"""Bronze, silver, gold, marts, windows, joins, top-k, semantic layer."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.functions import dates, text, values
from stratalake.operators import integrity, scd
from stratalake.operators.dedup import collapse_versions, dedup_latest, last_n
from stratalake.operators.frequent import frequent_values
from stratalake.plans import marts, recipes, semantic, silver
from stratalake.queries.registry import query
from stratalake.session import scratch_path
from stratalake.sources import bronze, bucketed
from stratalake.sources.driver_tables import EVENTS_AS_OF, ORDERS_AS_OF

# ---- bronze ------------------------------------------------------------------------------------------

query("src1_bronze_customers", "SELECT * FROM bronze_customers")(lambda t: t.bronze_customers)
query(
    "src2_bronze_orders",
    "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount) FROM bronze_orders",
)(lambda t: t.bronze_orders)
query("src3_bronze_products", "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM bronze_products")(lambda t: t.bronze_products)
query(
    "src4_bronze_vendors",
    "SELECT * REPLACE (lower(email) AS email, CAST(is_active AS INT) AS is_active) FROM raw_vendors",
)(lambda t: t.bronze_vendors)
query(
    "src5_bronze_purchase_orders",
    "SELECT * REPLACE (CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount) FROM raw_purchase_orders",
)(lambda t: t.bronze_purchase_orders)
query(
    "src6_bronze_rest_users",
    """SELECT c_custkey AS user_id, c_name AS name, lower(c_name || '@Rest.example.com') AS email, 'user' || c_custkey AS username,
      '+1-' || c_custkey AS phone, 'http://example.com/' || c_custkey AS website,
      '{"street":"Street ' || c_custkey || '","geo":{"lat":' || c_nationkey || '}}' AS address_json,
      '{"name":"' || c_mktsegment || '"}' AS company_json FROM customer""",
)(lambda t: bronze.bronze_rest_users(t.raw_rest_users))
query("src7_bronze_rest_posts", "SELECT * FROM raw_posts")(lambda t: t.bronze_posts)
query(
    "src8_bronze_rest_comments",
    """SELECT conv_id * 1000 + turn AS comment_id, conv_id AS post_id, role AS name,
      lower(role || conv_id || '@Example.com') AS email, text AS body FROM conversations""",
)(lambda t: bronze.bronze_rest_comments(t.raw_rest_comments))

# ---- silver ------------------------------------------------------------------------------------------

query("sil1_stg_customers", "SELECT * FROM stg_customers")(lambda t: t.stg_customers)
query(
    "sil2_stg_orders",
    "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(revenue AS DOUBLE) AS revenue) FROM stg_orders",
)(lambda t: t.stg_orders)
query("sil3_stg_products", "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM stg_products")(lambda t: t.stg_products)
query(
    "sil4_stg_purchase_orders",
    "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(fulfilled_amount AS DOUBLE) AS fulfilled_amount) FROM stg_purchase_orders",
)(lambda t: t.stg_purchase_orders)
query("sil5_stg_reviews", "SELECT * FROM stg_reviews")(lambda t: t.stg_reviews)
query("sil6_stg_vendors", "SELECT * FROM stg_vendors")(lambda t: t.stg_vendors)
query("sil7_stg_events", "SELECT * FROM stg_events")(lambda t: t.stg_events)
query("sil8_stg_subscriptions", "SELECT * FROM stg_subscriptions")(lambda t: t.stg_subscriptions)
query("sil9_stg_users", "SELECT * FROM stg_users")(lambda t: t.stg_users)
LATEST_CHANGE = """SELECT * FROM customer_changes
  QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC, lsn DESC) = 1"""
query("sil10_dedup_latest", LATEST_CHANGE)(lambda t: dedup_latest(t.customer_changes, ["customer_id"], ["updated_at", "lsn"]))
query("win1_row_number_latest", LATEST_CHANGE)(lambda t: dedup_latest(t.customer_changes, ["customer_id"], ["updated_at", "lsn"]))

# ---- dimensions and facts ----------------------------------------------------------------------------

query("dim1_customers", "SELECT * FROM dim_customers")(lambda t: t.dim_customers)
query("dim2_products", "SELECT * REPLACE (CAST(price AS DOUBLE) AS price) FROM dim_products")(lambda t: t.dim_products)
query("dim3_vendors", "SELECT * FROM dim_vendors")(lambda t: t.dim_vendors)
query("dim4_users", "SELECT * FROM dim_users")(lambda t: t.dim_users)
query(
    "scd1_initial_load",
    """SELECT customer_id, email, segment, country, created_at, created_at AS valid_from,
      TIMESTAMP '9999-12-31 23:59:59' AS valid_to, 1 AS is_current FROM stg_customers""",
)(lambda t: scd.scd2_init(t.stg_customers.select("customer_id", "email", "segment", "country", "created_at"), "created_at"))

TRACKED = ["email", "segment", "country"]
query(
    "scd2_history",
    """, marked AS (SELECT *, lag(segment || '/' || country) OVER w AS before FROM customer_changes
        WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at, lsn)),
      starts AS (SELECT * FROM marked WHERE before IS NULL OR before <> segment || '/' || country),
      ends AS (SELECT *, lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at, lsn) AS until FROM starts)
      SELECT customer_id, email, segment, country, updated_at AS valid_from,
        coalesce(until, TIMESTAMP '9999-12-31 23:59:59') AS valid_to, CASE WHEN until IS NULL THEN 1 ELSE 0 END AS is_current
      FROM ends""",
)(lambda t: scd.scd2_history(t.customer_changes, "customer_id", TRACKED, "updated_at", "lsn"))

SPLIT = "1999-01-01"


def _scd2_merge(t):
    """Dimension from the changes of the first years, then one merge of the newest images."""
    first = t.customer_changes.filter(F.col("updated_at") < SPLIT)
    dim = scd.scd2_history(first, "customer_id", TRACKED, "updated_at", "lsn")
    return scd.scd2_merge(dim, t.customer_changes.filter(F.col("updated_at") >= SPLIT), "customer_id", TRACKED)


MERGED = (
    f""", marked AS (SELECT *, lag(segment || '/' || country) OVER w AS before FROM customer_changes
        WHERE updated_at < TIMESTAMP '{SPLIT}' WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at, lsn)),
      starts AS (SELECT * FROM marked WHERE before IS NULL OR before <> segment || '/' || country),
      ends AS (SELECT *, lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at, lsn) AS until FROM starts),
      dim AS (SELECT customer_id, email, segment, country, updated_at AS valid_from,
        coalesce(until, TIMESTAMP '9999-12-31 23:59:59') AS valid_to, CASE WHEN until IS NULL THEN 1 ELSE 0 END AS is_current FROM ends),
      fresh AS (SELECT * FROM customer_changes WHERE updated_at >= TIMESTAMP '{SPLIT}' QUALIFY row_number() OVER
        (PARTITION BY customer_id ORDER BY updated_at DESC, email DESC, segment DESC, country DESC) = 1),
      changed AS (SELECT f.* FROM fresh f LEFT JOIN (SELECT * FROM dim WHERE is_current = 1) d ON f.customer_id = d.customer_id
        WHERE d.customer_id IS NULL OR d.segment <> f.segment OR d.country <> f.country OR d.email <> f.email)
      SELECT d.customer_id, d.email, d.segment, d.country, d.valid_from,
        CASE WHEN d.is_current = 1 AND c.customer_id IS NOT NULL THEN c.updated_at ELSE d.valid_to END AS valid_to,
        CASE WHEN c.customer_id IS NOT NULL THEN 0 ELSE d.is_current END AS is_current
      FROM dim d LEFT JOIN changed c ON d.customer_id = c.customer_id
      UNION ALL SELECT customer_id, email, segment, country, updated_at, TIMESTAMP '9999-12-31 23:59:59', 1 FROM changed"""
)
query("scd2_merge", MERGED)(_scd2_merge)


def _scd2_buckets(t):
    """The same merge on a bucketed dimension, delivered twice."""
    first = t.customer_changes.filter(F.col("updated_at") < SPLIT)
    dim = scd.scd2_history(first, "customer_id", TRACKED, "updated_at", "lsn").select("customer_id", *TRACKED, "valid_from", "valid_to", "is_current")
    path = scratch_path(t.spark, "dimension")
    bucketed.create(dim, path, ["customer_id"])
    for _ in range(2):
        changes = t.customer_changes.filter(F.col("updated_at") >= SPLIT)
        bucketed.merge(changes, path, dim, ["customer_id"], lambda old, new: scd.scd2_merge(old, new, "customer_id", TRACKED), 1)
    return bucketed.read(t.spark, path, dim, ["customer_id"])


query("scd2_bucket_merge", MERGED)(_scd2_buckets)
query("scd3_collapse_versions", "SELECT * FROM mart_enrichment")(
    lambda t: collapse_versions(t.products_enriched, ["product_id"], "enriched_at")
)
query(
    "scd4_current_only",
    """, h AS (SELECT *, lead(updated_at) OVER (PARTITION BY customer_id ORDER BY updated_at, lsn) AS until FROM (
        SELECT *, lag(segment || '/' || country) OVER (PARTITION BY customer_id ORDER BY updated_at, lsn) AS before FROM customer_changes)
        WHERE before IS NULL OR before <> segment || '/' || country)
      SELECT customer_id, segment, country, updated_at AS valid_from FROM h WHERE until IS NULL""",
)(
    lambda t: scd.current_only(scd.scd2_history(t.customer_changes, "customer_id", TRACKED, "updated_at", "lsn")).select(
        "customer_id", "segment", "country", "valid_from"
    )
)
query(
    "fct1_orders",
    "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(revenue AS DOUBLE) AS revenue) FROM fct_orders",
)(lambda t: t.with_dimensions("dim_products").fct_orders)
query(
    "fct2_procurement",
    "SELECT * REPLACE (CAST(amount AS DOUBLE) AS amount, CAST(fulfilled_amount AS DOUBLE) AS fulfilled_amount) FROM fct_procurement",
)(lambda t: t.with_dimensions("dim_vendors").fct_procurement)
query("fct3_reviews", "SELECT * FROM fct_reviews")(lambda t: t.fct_reviews)
query("fct4_unified_customers", "SELECT * FROM unified")(lambda t: t.unified)
query("fct5_product_enrichment", "SELECT * FROM mart_enrichment")(lambda t: t.mart_enrichment)

# ---- scalar functions --------------------------------------------------------------------------------

query(
    "fn1_clean_text",
    """SELECT customer_id, trim(first_name) AS first_name, lower(trim(email)) AS email, upper(trim(country)) AS country
      FROM raw_customers""",
)(
    lambda t: text.clean_text(
        t.raw_customers.select("customer_id", "first_name", "email", "country"), upper=["country"], lower=["email"], plain=["first_name"]
    )
)
query(
    "fn2_empty_to_null",
    "SELECT customer_id, nullif(trim(phone), '') AS phone, nullif(trim(city), '') AS city FROM raw_customers",
)(
    lambda t: t.raw_customers.select(
        "customer_id", text.empty_to_null(F.col("phone")).alias("phone"), text.empty_to_null(F.col("city")).alias("city")
    )
)
query(
    "fn3_title_case",
    """SELECT vendor_id, array_to_string([upper(x[1]) || lower(x[2:]) for x in
      regexp_extract_all(category, '[A-Za-z0-9]+|[^A-Za-z0-9]+')], '') AS category FROM raw_vendors""",
)(lambda t: t.raw_vendors.select("vendor_id", text.title_case(F.col("category")).alias("category")))
query(
    "fn4_whitelist",
    """SELECT order_id, CASE WHEN lower(status) IN ('pending', 'completed', 'cancelled') THEN lower(status) ELSE 'pending' END
      AS status FROM raw_orders""",
)(
    lambda t: t.raw_orders.select(
        "order_id", text.whitelist(F.col("status"), silver.ORDER_STATUSES, silver.DEFAULT_ORDER_STATUS, case=F.lower).alias("status")
    )
)
query(
    "fn5_price_tier",
    """SELECT product_id, CASE WHEN price < 50 THEN 'Budget' WHEN price < 200 THEN 'Mid-range' WHEN price < 500 THEN 'Premium'
      ELSE 'Luxury' END AS price_tier FROM raw_products""",
)(lambda t: t.raw_products.select("product_id", values.price_tier(F.col("price")).alias("price_tier")))
query(
    "fn6_amount_if",
    """SELECT order_id, CASE WHEN lower(status) = 'completed' THEN CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) ELSE 0.0 END
      AS revenue FROM raw_orders""",
)(
    lambda t: t.raw_orders.select(
        "order_id", values.amount_if(F.lower("status"), ["completed"], F.col("amount")).alias("revenue")
    )
)
query(
    "fn7_calendar_parts",
    """SELECT id, occurred_at, CAST(occurred_at AS DATE) AS occurred_at_day, CAST(date_trunc('month', occurred_at) AS DATE) AS
      occurred_at_month, CAST(year(occurred_at) AS INT) AS occurred_at_year, CAST(date_trunc('week', occurred_at) AS DATE) AS
      occurred_at_week, date_trunc('hour', occurred_at) AS occurred_at_hour FROM raw_saas_events""",
)(lambda t: dates.calendar_parts(t.raw_saas_events.select("id", "occurred_at"), "occurred_at"))
query(
    "fn8_days_between",
    "SELECT id, CAST(date_diff('day', created_at, updated_at) AS INT) AS days FROM raw_saas_users",
)(lambda t: t.raw_saas_users.select("id", dates.days_between(F.col("created_at"), F.col("updated_at")).alias("days")))
query(
    "fn9_shift_date",
    """SELECT order_id, CAST(CAST(order_date AS DATE) - to_days(90) AS DATE) AS minus_days,
      CAST(CAST(order_date AS DATE) + to_months(1) AS DATE) AS plus_month,
      CAST(CAST(order_date AS DATE) - to_months(6) AS DATE) AS minus_months,
      order_date + to_days(coalesce(quantity, 0)) AS plus_column FROM raw_orders""",
)(
    lambda t: t.raw_orders.select(
        "order_id",
        dates.shift_date(F.to_date("order_date"), -90).alias("minus_days"),
        dates.shift_date(F.to_date("order_date"), 1, "month").alias("plus_month"),
        dates.shift_date(F.to_date("order_date"), -6, "month").alias("minus_months"),
        dates.shift_timestamp(F.col("order_date"), F.coalesce("quantity", F.lit(0))).alias("plus_column"),
    )
)
query("fn10_surrogate_key", "SELECT customer_id, md5(CAST(customer_id AS VARCHAR)) AS customer_key FROM raw_customers")(
    lambda t: t.raw_customers.select("customer_id", values.surrogate_key(F.col("customer_id")).alias("customer_key"))
)
query(
    "fn11_version_of",
    "SELECT vendor_id, CAST(coalesce(epoch(updated_at), epoch(created_at), 0) AS BIGINT) AS version FROM raw_vendors",
)(
    lambda t: t.bronze_vendors.select(
        "vendor_id", values.version_of(F.col("updated_at"), F.col("created_at")).alias("version")
    )
)
query(
    "fn12_money",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS amount,
      CAST(round(CAST(o_totalprice AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded FROM orders""",
)(
    lambda t: t.table("orders").select(
        "o_orderkey",
        values.money(F.col("o_totalprice")).alias("amount"),
        F.round(values.money(F.col("o_totalprice")), 1).alias("rounded"),
    )
)
query(
    "fn13_null_handling",
    """SELECT order_id, coalesce(product_id, -1) AS product_id, nullif(status, 'refunded') AS status, product_id IS NULL AS is_missing,
      CASE WHEN coalesce(quantity, 0) = 0 THEN NULL ELSE amount / quantity END AS unit_amount FROM raw_orders""",
)(
    lambda t: t.raw_orders.select(
        "order_id",
        F.coalesce("product_id", F.lit(-1)).alias("product_id"),
        F.nullif(F.col("status"), F.lit("refunded")).alias("status"),
        F.col("product_id").isNull().alias("is_missing"),
        F.try_divide("amount", F.nullif(F.coalesce("quantity", F.lit(0)), F.lit(0))).alias("unit_amount"),
    )
)
query("fn14_synthetic_bucket", "SELECT doc_id, doc_id % 200 + 1 AS product_id, (doc_id + 1) % 5 + 1 AS rating FROM documents")(
    lambda t: t.table("documents").select(
        "doc_id",
        values.synthetic_bucket(F.col("doc_id") + 1, silver.REVIEWED_PRODUCTS).alias("product_id"),
        ((F.col("doc_id") + 1) % 5 + 1).alias("rating"),
    )
)
query(
    "fn15_pattern_predicates",
    """SELECT doc_id, text LIKE '%@%' AS has_at, text ILIKE '%THE%' AS has_the, contains(lower(text), 'license') AS has_license
      FROM documents""",
)(
    lambda t: t.table("documents").select(
        "doc_id",
        F.col("text").like("%@%").alias("has_at"),
        F.col("text").ilike("%THE%").alias("has_the"),
        text.contains_ci(F.col("text"), "License").alias("has_license"),
    )
)
query(
    "fn16_first_tags",
    "SELECT conv_id, turn, array_to_string(list_slice(string_split(text, ' '), 1, 5), '|') AS tags FROM conversations",
)(lambda t: t.table("conversations").select("conv_id", "turn", text.first_tags(F.split("text", " "), 5).alias("tags")))


def _fn17(t):
    from stratalake.streaming.cdc import PRODUCT

    row = text.unwrap_payload(F.col("value"), PRODUCT)
    rows = t.cdc_messages.select("offset", row.alias("row")).filter("row is not null")
    found = rows.select("offset", "row.product_id", "row.name", "row.price")
    return found.filter("product_id is not null or name <> 'no id'")


query(
    "fn17_unwrap_payload",
    """SELECT p_partkey * 2 + v AS "offset", p_partkey AS product_id, p_name AS name,
      round(p_retailprice * p_size / 50, 2) + v AS price FROM part JOIN (VALUES (0), (1)) x(v) ON v = 0 OR p_partkey % 3 = 0""",
)(_fn17)
query(
    "fn18_readable_size",
    """SELECT doc_id, CASE WHEN b >= 1073741824 THEN printf('%.2f GiB', b / 1073741824.0) WHEN b >= 1048576 THEN
      printf('%.2f MiB', b / 1048576.0) WHEN b >= 1024 THEN printf('%.2f KiB', b / 1024.0) ELSE printf('%.2f B', b) END AS size
      FROM (SELECT doc_id, CAST(n_chars * n_chars AS DOUBLE) AS b FROM documents)""",
)(
    lambda t: t.table("documents").select(
        "doc_id", text.readable_size(F.col("n_chars") * F.col("n_chars")).alias("size")
    )
)
query(
    "fn19_format_cells",
    """SELECT format('{:,}', order_id) AS order_id, coalesce(format('{:,}', product_id), '—') AS product_id,
      format('{:t,.2f}', amount) AS amount, strftime(order_date, '%Y-%m-%d') AS order_date, status FROM raw_orders""".replace("{:t,.2f}", "{:,.2f}"),
)(lambda t: text.format_cells(t.raw_orders.select("order_id", "product_id", "amount", "order_date", "status")))
query("fn20_snippet", "SELECT query_id, substring(query, 1, 100) AS snippet FROM query_log")(
    lambda t: t.query_log.select("query_id", text.snippet(F.col("query"), 100).alias("snippet"))
)

# ---- filters -----------------------------------------------------------------------------------------

query(
    "flt1_valid_rows",
    "SELECT order_id, customer_id, product_id FROM raw_orders WHERE order_id > 0 AND customer_id > 0 AND product_id > 0 AND amount > 0",
)(
    lambda t: silver.valid_rows(t.raw_orders, ["order_id", "customer_id", "product_id", "amount"]).select(
        "order_id", "customer_id", "product_id"
    )
)
query(
    "flt2_not_deleted",
    "SELECT customer_id FROM raw_customers WHERE _ab_cdc_deleted_at IS NULL OR _ab_cdc_deleted_at = ''",
)(lambda t: bronze.not_deleted(t.raw_customers).select("customer_id"))


def _flt3(t):
    day = F.to_date("o_orderdate")
    return t.table("orders").agg(
        *[
            F.count_if(dates.in_last(day, n, unit, ORDERS_AS_OF)).alias(name)
            for name, n, unit in [("last_30_days", 30, "day"), ("last_365_days", 365, "day"), ("last_6_months", 6, "month"), ("this_month", 0, "this_month")]
        ]
    )


query(
    "flt3_relative_windows",
    """SELECT count(*) FILTER (o_orderdate >= DATE '2001-07-02') AS last_30_days,
      count(*) FILTER (o_orderdate >= DATE '2000-08-01') AS last_365_days,
      count(*) FILTER (o_orderdate >= DATE '2001-02-01') AS last_6_months,
      count(*) FILTER (date_trunc('month', o_orderdate) = DATE '2001-08-01') AS this_month FROM orders""",
)(_flt3)
query(
    "flt4_having",
    """SELECT customer_id, count(*) AS orders, CAST(sum(revenue) AS DOUBLE) AS revenue FROM fct_orders GROUP BY customer_id
      HAVING count(*) > 5 AND sum(revenue) > 1000""",
)(
    lambda t: marts.per_customer_revenue(t.fct_orders)
    .filter((F.col("orders") > marts.LOYAL_ORDERS) & (F.col("revenue") > marts.LOYAL_REVENUE))
)
query(
    "flt5_scalar_subquery",
    "SELECT order_id, updated_at FROM stg_orders WHERE updated_at >= (SELECT date_trunc('hour', max(updated_at)) - INTERVAL 1 HOUR FROM stg_orders)",
)(lambda t: _recent_orders(t))


def _recent_orders(t):
    from stratalake.operators.incremental import new_rows

    rows = t.stg_orders.select("order_id", "updated_at")
    return new_rows(rows, rows, "updated_at")


# ---- joins -------------------------------------------------------------------------------------------

query(
    "jn1_orders_customers",
    """SELECT c.segment, c.country, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue FROM fct_orders f JOIN dim_customers c
      ON f.customer_key = c.customer_key AND c.is_current = 1 GROUP BY 1, 2""",
)(lambda t: recipes.join_orders_customers(t.fct_orders, t.dim_customers))
query(
    "jn2_orders_products",
    """SELECT p.category, p.price_tier, count(*) AS orders, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue FROM fct_orders f
      JOIN dim_products p ON f.product_key = p.product_key GROUP BY 1, 2""",
)(lambda t: recipes.join_orders_products(t.fct_orders, t.dim_products))
query(
    "jn3_reviews_products",
    """SELECT p.category, round(avg(rating), 2) AS avg_rating, count(*) AS reviews FROM fct_reviews r
      JOIN dim_products p ON r.product_key = p.product_key GROUP BY 1""",
)(lambda t: recipes.join_reviews_products(t.fct_reviews, t.dim_products))
query(
    "jn4_procurement_vendors",
    """SELECT v.name, v.country, CAST(round(sum(amount), 2) AS DOUBLE) AS spend, avg(lead_time_days) AS avg_lead_days
      FROM fct_procurement f JOIN dim_vendors v ON f.vendor_key = v.vendor_key GROUP BY 1, 2""",
)(lambda t: recipes.join_procurement_vendors(t.fct_procurement, t.dim_vendors))
query(
    "jn5_enrichment",
    """SELECT sentiment, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, count(*) AS orders FROM fct_orders f
      JOIN dim_products p ON f.product_key = p.product_key JOIN mart_enrichment m ON m.product_id = p.product_id GROUP BY 1""",
)(lambda t: recipes.join_enrichment(t.fct_orders, t.dim_products, t.mart_enrichment))
query(
    "jn6_left_join_current",
    """SELECT c.segment, count(*) AS orders FROM stg_orders o LEFT JOIN dim_customers c
      ON o.customer_id = c.customer_id AND c.is_current = 1 GROUP BY 1""",
)(lambda t: recipes.left_join_current(t.stg_orders, t.dim_customers))
query(
    "jn7_full_outer",
    "SELECT customer_type, count(*) AS customers, count(customer_id) AS store, count(user_id) AS saas FROM unified GROUP BY 1",
)(
    lambda t: t.unified.groupBy("customer_type").agg(
        F.count("*").alias("customers"), F.count("customer_id").alias("store"), F.count("user_id").alias("saas")
    )
)
MONTHLY = """, monthly AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, round(sum(revenue), 2) AS revenue
  FROM fct_orders GROUP BY 1)"""
query(
    "jn8_mom_self_join",
    MONTHLY
    + """, recent AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, round(sum(revenue), 2) AS revenue
        FROM fct_orders WHERE order_date >= DATE '2001-02-02' GROUP BY 1)
      SELECT c.month, CAST(c.revenue AS DOUBLE) AS revenue, CAST(p.revenue AS DOUBLE) AS prev_revenue, CASE WHEN p.revenue > 0 THEN
        round((CAST(c.revenue AS DOUBLE) - CAST(p.revenue AS DOUBLE)) / CAST(p.revenue AS DOUBLE) * 100, 1) END AS mom_growth_pct
      FROM recent c LEFT JOIN monthly p ON c.month = CAST(p.month + to_months(1) AS DATE)""",
)(lambda t: marts.mom_self_join(t.fct_orders, ORDERS_AS_OF))
query(
    "jn9_orphans",
    "SELECT count(*) AS orphans FROM fct_orders f WHERE NOT EXISTS (SELECT 1 FROM dim_customers c WHERE c.customer_key = f.customer_key)",
)(lambda t: integrity.orphans(t.fct_orders, t.dim_customers, "customer_id"))
query(
    "jn10_fk_violations",
    """SELECT product_id, count(*) AS rows FROM bronze_orders WHERE product_id IS NOT NULL AND product_id NOT IN
      (SELECT product_id FROM stg_products) GROUP BY 1""",
)(lambda t: integrity.fk_violations(t.bronze_orders, t.stg_products, "product_id"))
COHORTS = """, active AS (SELECT DISTINCT user_id, CAST(started_at AS DATE) AS day FROM stg_subscriptions),
  joined AS (SELECT a.user_id, a.day, c.cohort_day FROM active a JOIN (SELECT user_id, min(day) AS cohort_day FROM active GROUP BY 1) c
    ON a.user_id = c.user_id WHERE a.day >= c.cohort_day)"""
query("jn11_cohort_join", COHORTS + " SELECT * FROM joined")(lambda t: marts.cohort_days(t.stg_subscriptions))
query(
    "jn12_broadcast_threshold",
    """SELECT n_name, count(*) AS customers, CAST(sum(orders) AS BIGINT) AS orders FROM (SELECT c_nationkey, count(o_orderkey) AS orders
      FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_nationkey) JOIN nation ON n_nationkey = c_nationkey
      GROUP BY 1""",
)(
    lambda t: t.table("customer")
    .join(
        t.table("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n")), "c_custkey", "left"
    )
    .join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    .groupBy("n_name")
    .agg(F.count("*").alias("customers"), F.coalesce(F.sum("n"), F.lit(0)).alias("orders"))
)

# ---- aggregates --------------------------------------------------------------------------------------

query("agg1_daily_active_users", "SELECT * FROM fct_dau")(lambda t: t.fct_dau)
query("agg2_event_funnel", "SELECT * FROM fct_funnel")(lambda t: t.fct_funnel)
query("agg3_mrr", "SELECT * FROM fct_mrr")(lambda t: t.fct_mrr)
query("agg4_mrr_by_plan", "SELECT plan, sum(total_mrr) AS total_mrr FROM fct_mrr GROUP BY plan")(
    lambda t: marts.fct_mrr_by_plan(t.fct_mrr)
)
query(
    "agg5_customer_churn_rate",
    """SELECT month, round(churned * 100 / nullif(total, 0), 1) AS churn_rate, churned, total FROM (SELECT
      CAST(date_trunc('month', started_at) AS DATE) AS month, count(*) FILTER (status = 'cancelled') AS churned, count(*) AS total
      FROM stg_subscriptions GROUP BY 1)""",
)(lambda t: marts.fct_customer_churn_rate(t.stg_subscriptions))
query(
    "agg6_loyal_customers",
    """SELECT c.customer_key, full_name, country, CAST(sum(revenue) AS DOUBLE) AS total_revenue, count(order_id) AS order_count
      FROM fct_orders f JOIN dim_customers c ON f.customer_key = c.customer_key AND is_current = 1 GROUP BY 1, 2, 3
      HAVING count(order_id) > 5 AND sum(revenue) > 1000""",
)(lambda t: marts.fct_loyal_customers(t.fct_orders, t.dim_customers))
query(
    "agg7_clv_by_segment",
    """SELECT segment, CAST(sum(revenue) AS DOUBLE) AS lifetime_value FROM fct_orders f JOIN dim_customers c
      ON f.customer_key = c.customer_key AND is_current = 1 GROUP BY 1""",
)(lambda t: marts.fct_clv_by_segment(t.fct_orders, t.dim_customers))
query(
    "agg8_monthly_revenue_by_category",
    """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, category, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue
      FROM fct_orders f JOIN dim_products p ON f.product_key = p.product_key GROUP BY 1, 2""",
)(lambda t: marts.fct_monthly_revenue_by_category(t.fct_orders, t.dim_products))
query(
    "agg9_revenue_by_category",
    """SELECT product_category, CAST(order_date AS DATE) AS order_month, CAST(sum(revenue) AS DOUBLE) AS total_revenue
      FROM fct_orders GROUP BY 1, 2""",
)(lambda t: marts.fct_revenue_by_category(t.fct_orders))
query(
    "agg10_revenue_by_plan",
    """SELECT plan, CAST(date_trunc('month', started_at) AS DATE) AS month, round(sum(mrr), 2) AS revenue FROM stg_subscriptions
      WHERE started_at IS NOT NULL GROUP BY 1, 2""",
)(lambda t: marts.fct_revenue_by_plan(t.stg_subscriptions))
query(
    "agg11_rolling_revenue_by_category",
    """SELECT product_category, CAST(sum(revenue) AS DOUBLE) AS total_revenue FROM fct_orders WHERE status = 'completed'
      AND order_date_day >= DATE '2001-08-01' - 30 GROUP BY 1""",
)(lambda t: marts.fct_rolling_revenue_by_category(t.fct_orders, ORDERS_AS_OF))
VENDOR_SQL = """SELECT f.vendor_key, v.name AS vendor_name, count(*) AS total_orders,
  count(*) FILTER (delivery_date <= po_date + to_days({days})) AS on_time_deliveries,
  round(count(*) FILTER (delivery_date <= po_date + to_days({days})) * 100 / count(*), 1) AS on_time_delivery_rate,
  round(CAST(sum(amount) AS DOUBLE) / count(po_id), 2) AS average_order_size
  FROM fct_procurement f LEFT JOIN dim_vendors v ON f.vendor_key = v.vendor_key GROUP BY 1, 2"""
query("agg12_vendor_performance", VENDOR_SQL.format(days="lead_time_days"))(
    lambda t: marts.fct_vendor_performance(t.fct_procurement, t.dim_vendors)
)
query("agg12_vendor_performance_promised", VENDOR_SQL.format(days="30"))(
    lambda t: marts.fct_vendor_performance(t.fct_procurement, t.dim_vendors, promised_days=30)
)
query(
    "agg13_monthly_revenue_trend",
    """, monthly AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, product_category AS category,
        CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue FROM fct_orders GROUP BY 1, 2),
      recent AS (SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, product_category AS category,
        CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue FROM fct_orders WHERE order_date >= DATE '2001-08-01' - 180 GROUP BY 1, 2)
      SELECT c.month, c.category, c.revenue, p.revenue AS prev_revenue,
        CASE WHEN p.revenue > 0 THEN round((c.revenue - p.revenue) / p.revenue * 100, 1) END AS mom_growth_pct
      FROM recent c LEFT JOIN monthly p ON c.month = CAST(p.month + to_months(1) AS DATE) AND c.category = p.category""",
)(lambda t: marts.fct_monthly_revenue_trend(t.fct_orders, ORDERS_AS_OF))


def _agg14(t):
    from stratalake.plans.profile360 import order_aggregates

    return order_aggregates(t.fct_orders)


query(
    "agg14_order_aggregates",
    """SELECT customer_id, count(*) AS shopflow_order_count, CAST(sum(revenue) AS DOUBLE) AS total_shopflow_revenue
      FROM fct_orders GROUP BY 1""",
)(_agg14)
query(
    "agg15_kpi_totals",
    """SELECT CAST(sum(revenue) FILTER (status = 'completed') AS DOUBLE) AS total_revenue, count(*) AS total_orders,
      (SELECT count(*) FROM dim_users WHERE status = 'active') AS active_users, (SELECT sum(total_mrr) FROM fct_mrr) AS total_mrr
      FROM fct_orders""",
)(lambda t: recipes.kpi_totals(t.fct_orders, t.dim_users, t.fct_mrr))
query(
    "agg16_monthly_revenue",
    """SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(revenue) AS DOUBLE) AS revenue FROM fct_orders
      WHERE status = 'completed' AND order_date IS NOT NULL GROUP BY 1""",
)(lambda t: recipes.monthly_revenue(t.fct_orders))
query(
    "agg17_category_summary",
    """SELECT product_category AS category, count(*) AS orders, CAST(sum(revenue) AS DOUBLE) AS revenue,
      CAST(round(CAST(sum(revenue) AS DECIMAL(38,6)) / count(*), 2) AS DOUBLE) AS avg_order_value FROM fct_orders
      WHERE product_category IS NOT NULL GROUP BY 1 ORDER BY revenue DESC, category LIMIT 10""",
)(lambda t: recipes.category_summary(t.fct_orders))
query(
    "agg18_cross_domain_kpis",
    """SELECT count(*) AS customers, sum(saas_mrr) AS mrr, round(avg(total_shopflow_revenue + saas_mrr * 12), 2) AS avg_annual_value
      FROM unified WHERE customer_type = 'cross_domain'""",
)(lambda t: recipes.cross_domain_kpis(t.unified))
query(
    "agg19_customer_type_breakdown",
    """SELECT customer_type, count(*) AS customers, round(sum(saas_mrr), 2) AS total_saas_mrr,
      round(sum(total_shopflow_revenue), 2) AS total_shopflow_rev, round(sum(total_shopflow_revenue + saas_mrr * 12), 2) AS annual_value
      FROM unified GROUP BY 1""",
)(lambda t: recipes.customer_type_breakdown(t.unified))
query(
    "agg20_revenue_by_dimension",
    " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS value, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, count(*) AS orders FROM fct_orders GROUP BY {d}"
        for d in recipes.REVENUE_DIMENSIONS
    ),
)(lambda t: recipes.revenue_by_all(t.fct_orders))
query(
    "agg20_revenue_by_country",
    "SELECT customer_country, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, count(*) AS orders FROM fct_orders GROUP BY 1",
)(lambda t: recipes.revenue_by(t.fct_orders, "customer_country"))
query(
    "agg21_avg_dau_by_month",
    "SELECT CAST(date_trunc('month', event_date) AS DATE) AS month, round(avg(dau), 0) AS avg_dau FROM fct_dau GROUP BY 1",
)(lambda t: recipes.avg_dau_by_month(t.fct_dau))
query(
    "agg21_dau_series",
    "SELECT event_date, dau, total_events, logins, signups FROM fct_dau WHERE event_date >= DATE '2024-01-31' - 30",
)(lambda t: recipes.dau_series(t.fct_dau, 30, EVENTS_AS_OF))
query(
    "agg22_churn_pct",
    """SELECT round(count(*) FILTER (is_churned = 1) * 100 / count(*), 1) AS churn_pct, count(*) FILTER (is_churned = 1) AS churned,
      count(*) AS total FROM dim_users""",
)(lambda t: recipes.churn_pct(t.dim_users))
query(
    "agg22_paying_by_plan",
    "SELECT plan, count(*) AS subscribers, round(sum(mrr), 2) AS mrr FROM dim_users WHERE is_churned = 0 AND is_free = 0 GROUP BY 1",
)(lambda t: recipes.paying_by_plan(t.dim_users))
query(
    "agg23_sentiment_distribution",
    """SELECT sentiment, count(*) AS products, CAST(round(CAST(sum(price) AS DECIMAL(38,6)) / count(*), 2) AS DOUBLE) AS avg_price
      FROM mart_enrichment m JOIN dim_products p ON m.product_id = p.product_id GROUP BY 1""",
)(lambda t: recipes.sentiment_distribution(t.mart_enrichment, t.dim_products))
query(
    "agg23_revenue_by_quality_tier",
    """SELECT quality_tier, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue, count(*) AS orders FROM fct_orders f
      JOIN dim_products p ON f.product_key = p.product_key JOIN mart_enrichment m ON m.product_id = p.product_id GROUP BY 1""",
)(lambda t: recipes.join_enrichment(t.fct_orders, t.dim_products, t.mart_enrichment, "quality_tier"))
WORST = """SELECT original_category, count(*) FILTER (sentiment = 'negative') AS negative_products FROM mart_enrichment GROUP BY 1
  ORDER BY 2 DESC, 1 LIMIT 10"""
query("agg23_negatives_by_category", WORST)(lambda t: recipes.worst_categories(t.mart_enrichment))
query("agg24_mrr_by_plan", "SELECT plan, sum(total_mrr) AS total_mrr FROM fct_mrr GROUP BY 1")(
    lambda t: marts.fct_mrr_by_plan(t.fct_mrr)
)
query(
    "agg24_mrr_table",
    "SELECT plan, billing_cycle, total_subscribers, active_subscribers, churned_subscribers, total_mrr FROM fct_mrr",
)(lambda t: recipes.mrr_table(t.fct_mrr))
query("agg25_customers_by_segment", "SELECT segment, count(*) AS rows FROM bronze_customers GROUP BY 1")(
    lambda t: recipes.rows_by(t.bronze_customers, "segment")
)
query("agg25_orders_by_status", "SELECT status, count(*) AS rows FROM bronze_orders GROUP BY 1")(
    lambda t: recipes.rows_by(t.bronze_orders, "status")
)
query(
    "agg25_monthly_amount",
    "SELECT CAST(date_trunc('month', order_date) AS DATE) AS month, CAST(sum(amount) AS DOUBLE) AS revenue FROM bronze_orders GROUP BY 1",
)(lambda t: recipes.monthly_amount(t.bronze_orders))
query(
    "agg25_top_spenders",
    "SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS total FROM bronze_orders GROUP BY 1 ORDER BY sum(amount) DESC, 1 LIMIT 10",
)(lambda t: recipes.top_spenders(t.bronze_orders))
query("agg25_order_count", "SELECT count(*) AS orders FROM bronze_orders")(
    lambda t: t.bronze_orders.agg(F.count("*").alias("orders"))
)
query("agg25_customer_count", "SELECT count(*) AS customers FROM bronze_customers")(
    lambda t: t.bronze_customers.agg(F.count("*").alias("customers"))
)

# ---- windows -----------------------------------------------------------------------------------------

query(
    "win2_best_plan",
    """SELECT email, saas_plan AS plan, saas_mrr AS mrr, total_shopflow_revenue FROM unified WHERE email IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY email ORDER BY saas_mrr DESC, user_id NULLS LAST, customer_id NULLS LAST) = 1""",
)(lambda t: marts.best_plan(t.unified))
query(
    "win3_funnel_pct",
    """SELECT event_type, total_events, unique_users, round(unique_users * 100 / max(unique_users) OVER (), 1) AS pct_of_top
      FROM fct_funnel""",
)(lambda t: marts.funnel_pct(t.fct_funnel))
query(
    "win4_weekly_active_users",
    COHORTS
    + """ SELECT user_id, day, cohort_day, count(DISTINCT user_id) OVER (PARTITION BY cohort_day ORDER BY day, user_id
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS active_users_7d FROM joined""",
)(lambda t: marts.fct_weekly_active_users(t.stg_subscriptions))
JOURNEY = """SELECT u.email, u.created_at AS signup_date, u.plan AS initial_plan, u.mrr AS initial_mrr, p.plan, p.mrr,
  p.total_shopflow_revenue, c.ended_at AS churn_date, CASE WHEN c.status = '{status}' THEN 1 ELSE 0 END AS is_churned
  FROM dim_users u LEFT JOIN (SELECT email, saas_plan AS plan, saas_mrr AS mrr, total_shopflow_revenue FROM unified QUALIFY
    row_number() OVER (PARTITION BY email ORDER BY saas_mrr DESC, user_id NULLS LAST, customer_id NULLS LAST) = 1) p ON u.email = p.email
  LEFT JOIN (SELECT email, status, ended_at FROM dim_users WHERE status = '{status}') c ON u.email = c.email"""
query("win5_customer_journey", JOURNEY.format(status="cancelled"))(lambda t: marts.fct_customer_journey(t.dim_users, t.unified))
query("win5_customer_journey_churned", JOURNEY.format(status="churned"))(
    lambda t: marts.fct_customer_journey(t.dim_users, t.unified, churned_status="churned")
)
query(
    "win6_mom_lag",
    MONTHLY
    + """ SELECT month, CAST(revenue AS DOUBLE) AS revenue, CAST(prev AS DOUBLE) AS prev_revenue, CASE WHEN prev > 0 THEN
        round((CAST(revenue AS DOUBLE) - CAST(prev AS DOUBLE)) / CAST(prev AS DOUBLE) * 100, 1) END AS mom_growth_pct
      FROM (SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS prev FROM monthly WHERE month >= DATE '2001-01-01')
      WHERE month >= DATE '2001-02-01'""",
)(lambda t: marts.mom_lag(t.fct_orders, 6, ORDERS_AS_OF))

# ---- top-k -------------------------------------------------------------------------------------------

query(
    "top1_customers_by_spend",
    """SELECT c.customer_id, full_name AS name, CAST(round(sum(revenue), 2) AS DOUBLE) AS total_spend FROM fct_orders f
      JOIN dim_customers c ON f.customer_key = c.customer_key AND is_current = 1 GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 10""",
)(lambda t: marts.fct_top_customers_by_spend(t.fct_orders, t.dim_customers))
query(
    "top2_products",
    """SELECT product_name, product_category, count(*) AS orders, CAST(sum(revenue) AS DOUBLE) AS revenue FROM fct_orders
      GROUP BY 1, 2 ORDER BY 4 DESC, 1, 2 LIMIT 10""",
)(lambda t: recipes.top_products(t.fct_orders))
query(
    "top3_cross_domain",
    """SELECT email, full_name, saas_plan AS plan, round(saas_mrr, 2) AS saas_mrr, round(total_shopflow_revenue, 2) AS
      total_shopflow_revenue, round(total_shopflow_revenue + saas_mrr * 12, 2) AS annual_value FROM unified
      WHERE customer_type = 'cross_domain' ORDER BY annual_value DESC, email LIMIT 20""",
)(lambda t: recipes.top_cross_domain(t.unified, 20))


def _top4(t):
    from stratalake.operators.profiling import top_values, value_counts

    return top_values(value_counts(t.stg_customers, ["segment", "country", "city"]))


VALUES = " UNION ALL ".join(
    f"(SELECT '{c}' AS column_name, {c} AS value, count(*) AS rows FROM stg_customers GROUP BY {c} ORDER BY 3 DESC, 2 NULLS FIRST LIMIT 5)"
    for c in ("segment", "country", "city")
)
query("top4_values_per_column", VALUES)(_top4)
query("top4_values_in_two_passes", VALUES)(lambda t: frequent_values(t.stg_customers, ["segment", "country", "city"]))
query(
    "top5_last_messages",
    "SELECT * FROM messages QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY created_at DESC, turn DESC) <= 3",
)(lambda t: last_n(t.messages, ["session_id"], ["created_at", "turn"], 3))
query("top6_worst_categories", WORST)(lambda t: recipes.worst_categories(t.mart_enrichment))

# ---- generated tables and semantic layer -------------------------------------------------------------

SPINE = "SELECT CAST(unnest(generate_series(min(ts)::DATE::TIMESTAMP, max(ts)::DATE::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS date_day FROM events"
query("set3_time_spine", SPINE)(lambda t: semantic.spine_of(t.table("events"), "ts"))


def _tables(t):
    return {
        "fct_orders": t.fct_orders,
        "dim_customers": t.dim_customers,
        "dim_products": t.dim_products,
        "dim_users": t.dim_users,
        "stg_subscriptions": t.stg_subscriptions,
        "stg_events": t.stg_events,
    }


def _met1(t):
    """Every metric of the registry as one row."""
    return semantic.all_metrics(_tables(t)).withColumn("value", F.round("value", 4))


query(
    "met1_registry",
    """SELECT 'revenue' AS metric, round(CAST(sum(revenue) AS DOUBLE), 4) AS value FROM fct_orders
      UNION ALL SELECT 'orders_count', count(order_id) FROM fct_orders
      UNION ALL SELECT 'avg_order_value', round(CAST(sum(revenue) AS DECIMAL(38,6)) / count(*), 4) FROM fct_orders
      UNION ALL SELECT 'active_customers', count(*) FROM dim_customers WHERE is_current = 1
      UNION ALL SELECT 'mrr', sum(mrr) FROM stg_subscriptions
      UNION ALL SELECT 'subscribers', count(DISTINCT user_id) FROM stg_subscriptions
      UNION ALL SELECT 'dau', count(DISTINCT user_id) FROM stg_events
      UNION ALL SELECT 'revenue_per_customer', round(CAST(sum(revenue) AS DOUBLE) / (SELECT count(*) FROM dim_customers), 4) FROM fct_orders""",
)(_met1)
query(
    "met2_revenue_by_status_month",
    """SELECT status AS order_status, CAST(date_trunc('month', order_date) AS DATE) AS period, CAST(sum(revenue) AS DOUBLE) AS revenue
      FROM fct_orders GROUP BY 1, 2""",
)(lambda t: semantic.query_metric(_tables(t), "revenue", ["order_status"], "month"))
query(
    "met2_mrr_by_plan_month",
    """SELECT plan, CAST(date_trunc('month', started_at) AS DATE) AS period, sum(mrr) AS mrr FROM stg_subscriptions GROUP BY 1, 2""",
)(lambda t: semantic.query_metric(_tables(t), "mrr", ["plan"], "month"))
query(
    "met2_dau_by_day",
    "SELECT CAST(occurred_at AS DATE) AS period, count(DISTINCT user_id) AS dau FROM stg_events GROUP BY 1",
)(lambda t: semantic.query_metric(_tables(t), "dau", [], "day"))
query(
    "met3_revenue_per_customer",
    """SELECT r.customer_segment, CAST(r.revenue AS DOUBLE) AS revenue, c.n AS active_customers, CAST(r.revenue AS DOUBLE) / c.n AS revenue_per_customer
      FROM (SELECT customer_segment, sum(revenue) AS revenue FROM fct_orders GROUP BY 1) r
      LEFT JOIN (SELECT segment, count(*) AS n FROM dim_customers WHERE is_current = 1 GROUP BY 1) c ON r.customer_segment = c.segment""",
)(lambda t: semantic.query_metric(_tables(t), "revenue_per_customer", ["customer_segment"]))


# Dimensions that another model declares, reached over the entities.
WHO = "(SELECT * FROM dim_customers WHERE is_current = 1) c"
query(
    "met2_revenue_by_city",
    f"SELECT c.city, CAST(sum(f.revenue) AS DOUBLE) AS revenue FROM fct_orders f LEFT JOIN {WHO} ON f.customer_key = c.customer_key GROUP BY 1",
)(lambda t: semantic.query_metric(_tables(t), "revenue", ["city"]))
query(
    "met2_orders_by_category_city_month",
    f"""SELECT p.category, c.city, f.status AS order_status, CAST(date_trunc('month', f.order_date) AS DATE) AS period, count(f.order_id) AS orders_count
      FROM fct_orders f LEFT JOIN dim_products p ON f.product_key = p.product_key LEFT JOIN {WHO} ON f.customer_key = c.customer_key GROUP BY ALL""",
)(lambda t: semantic.query_metric(_tables(t), "orders_count", ["category", "customer__city", "order_status"], "month").withColumnRenamed("customer__city", "city"))
query(
    "met2_dau_by_country_day",
    """SELECT u.country AS user_country, CAST(e.occurred_at AS DATE) AS period, count(DISTINCT e.user_id) AS dau FROM stg_events e
      LEFT JOIN dim_users u ON e.user_id = u.user_id GROUP BY 1, 2""",
)(lambda t: semantic.query_metric(_tables(t), "dau", ["user_country"], "day"))
query(
    "met3_revenue_per_customer_by_city",
    f"""SELECT r.city, r.revenue, n.active_customers, r.revenue / n.active_customers AS revenue_per_customer FROM
      (SELECT c.city, CAST(sum(f.revenue) AS DOUBLE) AS revenue FROM fct_orders f LEFT JOIN {WHO} ON f.customer_key = c.customer_key GROUP BY 1) r
      LEFT JOIN (SELECT city, count(*) AS active_customers FROM dim_customers WHERE is_current = 1 GROUP BY 1) n ON r.city = n.city""",
)(lambda t: semantic.query_metric(_tables(t), "revenue_per_customer", ["city"]))


def _met4(t):
    """Large orders per day on a dense calendar: quiet days become 0."""
    daily = t.fct_orders.filter(F.col("amount") > 400000).groupBy("order_date_day").agg(
        F.count("*").alias("orders"), F.sum("revenue").alias("revenue")
    )
    return semantic.densify(daily, semantic.spine_of(t.fct_orders, "order_date"), "order_date_day", zero=["orders"])


query(
    "met4_densify",
    """, spine AS (SELECT CAST(unnest(generate_series(min(order_date), max(order_date), INTERVAL 1 DAY)) AS DATE) AS date_day FROM fct_orders)
      SELECT date_day, coalesce(orders, 0) AS orders, CAST(revenue AS DOUBLE) AS revenue FROM spine LEFT JOIN (SELECT order_date_day,
        count(*) AS orders, sum(revenue) AS revenue FROM fct_orders WHERE amount > 400000 GROUP BY 1) ON date_day = order_date_day""",
)(_met4)

