"""Named views of the comparison SQL: the same entities as the Spark models, written for a plain SQL engine.

A query gets only the views it mentions, directly or through other views.
"""

from __future__ import annotations

import re

TITLE = "array_to_string([upper(x[1]) || lower(x[2:]) for x in regexp_extract_all(trim({0}), '[A-Za-z0-9]+|[^A-Za-z0-9]+')], '')"
BLANK = "CASE WHEN trim({0}) = '' THEN NULL ELSE trim({0}) END"

VIEWS: dict[str, str] = {}

VIEWS["raw_customers"] = """
SELECT c_custkey AS customer_id, ' ' || split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
  ' ' || c_name || '@Example.com ' AS email,
  CASE WHEN c_custkey % 7 = 0 THEN '' ELSE '+1-555-' || c_custkey END AS phone,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'b2b' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'VIP'
       WHEN c_mktsegment = 'HOUSEHOLD' THEN 'B2C' ELSE 'retail' END AS segment,
  lower(n_name) AS country, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'City ' || (c_custkey % 50) END AS city,
  TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 2000 AS INT)) AS created_at,
  TIMESTAMP '1995-01-01' + to_days(CAST(c_custkey % 2000 + c_custkey % 365 AS INT)) AS updated_at,
  CASE WHEN c_custkey % 97 = 5 THEN '2001-01-01' WHEN c_custkey % 2 = 0 THEN '' END AS _ab_cdc_deleted_at,
  TIMESTAMP '2001-07-30 06:00:00' + to_hours(CAST(c_custkey % 24 AS INT)) AS _airbyte_extracted_at
FROM customer JOIN nation ON c_nationkey = n_nationkey"""

VIEWS["raw_orders"] = """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, product_id, o_totalprice AS amount, quantity,
  CASE WHEN o_orderkey % 50 = 3 THEN 'refunded' WHEN o_orderstatus = 'F' THEN 'COMPLETED'
       WHEN o_orderstatus = 'O' THEN 'pending' ELSE 'Cancelled' END AS status,
  o_orderdate AS order_date, o_orderdate + to_hours(CAST(o_orderkey % 48 AS INT)) AS updated_at,
  CASE WHEN o_orderkey % 89 = 4 THEN '2001-01-01' END AS _ab_cdc_deleted_at,
  TIMESTAMP '2001-07-30 06:00:00' + to_hours(CAST(o_orderkey % 24 AS INT)) AS _airbyte_extracted_at
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS product_id, CAST(count(*) AS INT) AS quantity
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey"""

VIEWS["raw_products"] = """
SELECT p_partkey AS product_id, ' ' || p_name AS name, lower(p_type) || '-line' AS category,
  round(p_retailprice * p_size / 50, 2) AS price, p_partkey % 100 - 2 AS stock_qty,
  ' ' || lower(p_brand) || '-' || p_partkey AS sku,
  TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey % 300 AS INT)) AS created_at,
  TIMESTAMP '1995-01-01' + to_days(CAST(p_partkey % 300 + p_partkey % 1000 AS INT)) AS updated_at,
  CASE WHEN p_partkey % 101 = 7 THEN '2001-01-01' END AS _ab_cdc_deleted_at,
  TIMESTAMP '2001-07-30 06:00:00' + to_hours(CAST(p_partkey % 24 AS INT)) AS _airbyte_extracted_at
FROM part"""

VIEWS["raw_vendors"] = """
SELECT 'V' || s_suppkey AS vendor_id, s_name || ' ' AS name, ' Contact ' || s_suppkey AS contact_name,
  'Vendor' || s_suppkey || '@Example.com' AS email,
  CASE WHEN s_suppkey % 6 = 0 THEN '' ELSE '+49-' || s_suppkey END AS phone, lower(n_name) AS country,
  CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE 'Town ' || (s_suppkey % 30) END AS city,
  ['raw-materials', 'logistics', 'it services', 'packaging', 'office supplies', 'energy'][s_suppkey % 6 + 1] AS category,
  ['net30', 'net60', 'net90', 'immediate'][s_suppkey % 4 + 1] AS payment_terms, s_suppkey % 10 <> 0 AS is_active,
  TIMESTAMP '1995-01-01' + to_days(CAST(s_suppkey % 1000 AS INT)) AS created_at,
  CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE TIMESTAMP '1995-01-01' + to_days(CAST(s_suppkey % 1000 AS INT)) END AS updated_at
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

VIEWS["raw_purchase_orders"] = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) - DATE '1970-01-01') AS po_id,
  'V' || l_suppkey AS vendor_id, l_extendedprice AS amount, ['usd', ' eur', 'gbp ', 'inr'][l_linenumber % 4 + 1] AS currency,
  CASE l_returnflag WHEN 'R' THEN 'received' WHEN 'A' THEN 'approved' ELSE 'Backlog' END AS status,
  CAST(l_quantity AS INT) AS line_items, ' PO line ' || l_linenumber AS description, 'buyer_' || (l_partkey % 20) AS requested_by,
  l_shipdate AS po_date, l_shipdate + to_days(CAST((l_partkey + 13 * l_linenumber) % 60 AS INT)) AS delivery_date,
  l_shipdate AS created_at, l_shipdate + to_hours(l_linenumber) AS updated_at
FROM lineitem"""

VIEWS["raw_posts"] = """
SELECT doc_id + 1 AS post_id, doc_id % 150 + 1 AS user_id, concat_ws(' ', ' Review', source, lang, doc_id) AS title, text AS body
FROM documents"""

VIEWS["customer_changes"] = """
SELECT o_custkey AS customer_id, 'customer' || o_custkey || '@example.com' AS email,
  CASE WHEN substring(o_orderpriority, 1, 1) IN ('1', '2') THEN 'VIP' ELSE 'B2C' END AS segment,
  CASE WHEN o_orderkey % 40 = 0 THEN 'MOVED' ELSE 'HOME' END AS country,
  o_orderdate + to_minutes(CAST(o_orderkey % 1440 AS INT)) AS updated_at, o_orderkey AS lsn,
  CASE WHEN o_orderkey % 25 = 7 THEN '2001-01-01' END AS _ab_cdc_deleted_at
FROM orders"""

VIEWS["raw_saas_events"] = """
SELECT event_id AS id, user_id,
  CASE WHEN event_type = 'view' THEN 'page_view' WHEN event_type = 'purchase' THEN 'upgrade'
       WHEN event_type = 'error' THEN 'payment_failed' WHEN event_type = 'click' AND event_id % 2 = 0 THEN 'login'
       ELSE event_type END AS event_type,
  ['/billing', '/reports', '/settings', '/dashboard', '/pricing'][CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 + 1] AS page,
  props AS properties, ts AS occurred_at
FROM events"""

VIEWS["raw_saas_users"] = """
SELECT user_id AS id, 'customer#' || lpad(CAST(user_id * 20 AS VARCHAR), 9, '0') || '@example.com' AS email,
  'User ' || user_id AS name, 'Company ' || (user_id % 40) AS company, 'NATION_' || (user_id % 25) AS country,
  ['Free', 'Starter', 'Growth', 'Enterprise'][user_id % 4 + 1] AS plan,
  CAST([0.0, 29.0, 99.0, 499.0][user_id % 4 + 1] AS DOUBLE) AS mrr,
  CASE WHEN user_id % 5 = 0 THEN 'Churned' WHEN user_id % 5 = 1 THEN 'trial' ELSE 'active' END AS status,
  min(ts) AS created_at, max(ts) AS updated_at
FROM events GROUP BY user_id"""

VIEWS["raw_saas_subscriptions"] = """
SELECT event_id AS id, user_id, ['Free', 'Starter', 'Growth', 'Enterprise'][event_id % 4 + 1] AS plan,
  CAST([0.0, 29.0, 99.0, 499.0][event_id % 4 + 1] AS DOUBLE) AS amount,
  CASE WHEN event_id % 2 = 1 THEN 'annual' ELSE 'monthly' END AS billing_cycle, ts AS started_at,
  ts + to_days(CASE WHEN event_id % 2 = 1 THEN 365 ELSE 30 END) AS expires_at,
  ['Active', 'cancelled', 'expired'][event_id % 3 + 1] AS status, ts AS created_at
FROM events WHERE event_type = 'signup'"""

VIEWS["products_enriched"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS original_category, p_type || '/' || p_brand AS enriched_category,
  ['positive', 'neutral', 'negative'][(p_partkey + version) % 3 + 1] AS sentiment,
  CASE WHEN round(p_retailprice * p_size / 50, 2) > 100 THEN 'premium' WHEN round(p_retailprice * p_size / 50, 2) < 20
       THEN 'budget' ELSE 'standard' END AS quality_tier,
  replace(p_name, ' ', '|') AS keywords,
  TIMESTAMP '2001-07-31' + to_hours(version * 2) + to_minutes(CAST(p_partkey % 600 AS INT)) AS enriched_at
FROM part JOIN (VALUES (0), (1)) v(version) ON version = 0 OR p_partkey % 3 = 0"""

VIEWS["messages"] = """
SELECT CAST(conv_id AS VARCHAR) AS session_id, turn, role,
  text || ' ' || ['data contract', 'dag failed', 'null rate of a column', 'revenue trend', 'slow query', 'schema drift',
    'hello there'][(conv_id + turn) % 7 + 1] AS content,
  ['insight', 'quality', 'schema', 'contract', 'anomaly'][(conv_id + turn) % 5 + 1] AS agent,
  TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 30 AS INT)) + to_minutes(turn) AS created_at
FROM conversations"""

VIEWS["calls"] = """
SELECT conv_id * 1000 + turn AS id, CAST(conv_id AS VARCHAR) AS session_id,
  ['insight', 'quality', 'schema', 'contract', 'anomaly'][(conv_id + turn) % 5 + 1] AS agent,
  CAST(length(text) AS BIGINT) AS input_tokens, CAST(len(string_split(text, ' ')) AS BIGINT) AS output_tokens,
  CASE WHEN turn % 6 = 5 THEN NULL ELSE length(text) % 3000 END AS latency_ms,
  TIMESTAMP '2024-01-01' + to_days(CAST(conv_id % 30 AS INT)) + to_minutes(turn) AS created_at
FROM conversations"""

VIEWS["priced_calls"] = """
SELECT *, CAST(round(CAST(input_tokens AS DECIMAL(18,0)) * 0.00000011, 6) AS DECIMAL(10,6)) AS input_cost,
  CAST(round(CAST(output_tokens AS DECIMAL(18,0)) * 0.00000034, 6) AS DECIMAL(10,6)) AS output_cost,
  CAST(round(CAST(input_tokens AS DECIMAL(18,0)) * 0.00000011 + CAST(output_tokens AS DECIMAL(18,0)) * 0.00000034, 6)
    AS DECIMAL(10,6)) AS total_cost
FROM calls"""

VIEWS["query_log"] = """
SELECT conv_id * 1000 + turn AS query_id,
  CASE WHEN (conv_id + turn) % 13 = 0 THEN 'INSERT INTO raw.t ' ELSE '' END || 'SELECT ' ||
  ['revenue', 'order_id', 'customer_key', 'segment', 'category', 'price_tier', 'dau', 'total_mrr', 'status',
   'amount'][(conv_id * 3 + turn) % 10 + 1] || ' FROM gold.' ||
  ['fct_orders', 'dim_customers', 'dim_products', 'fct_mrr', 'fct_daily_active_users'][(conv_id + turn) % 5 + 1] || ' -- ' || text AS query,
  CASE WHEN (conv_id + turn) % 11 = 0 THEN 'ExceptionWhileProcessing' ELSE 'QueryFinish' END AS type,
  CASE WHEN (conv_id + turn) % 13 = 0 THEN 'Insert' ELSE 'Select' END AS query_kind,
  TIMESTAMP '2024-01-30' + to_minutes((conv_id * 7 + turn * 31) % 2880) AS event_time,
  CAST(length(text) AS BIGINT) * 3 % 5000 AS query_duration_ms, CAST(length(text) AS BIGINT) * 100 AS read_rows,
  CAST(length(text) AS BIGINT) * 4096 AS read_bytes, CAST(length(text) AS BIGINT) * length(text) * 1024 AS memory_usage,
  CAST(turn % 2 AS INT) AS is_initial_query
FROM conversations"""

VIEWS["runs"] = """
SELECT 'dag_' || (user_id % 7) AS dag_id, 'run_' || event_id AS dag_run_id,
  CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'click' THEN 'running' ELSE 'success' END AS state,
  ts AS start_date, CASE WHEN event_type <> 'click' THEN ts + to_seconds(CAST(floor(value * 60) AS BIGINT)) END AS end_date
FROM events"""

VIEWS["timed_runs"] = """
SELECT *, round((epoch(date_trunc('second', end_date)) - epoch(date_trunc('second', start_date))) / 60.0, 1) AS duration_min
FROM runs"""

VIEWS["task_tries"] = """
SELECT 'run_' || user_id || '_' || strftime(ts, '%Y%m%d') AS run_id, 'task_' || (event_id % 2) AS task_id,
  CASE WHEN event_type IN ('error', 'click', 'view') THEN 'failed' ELSE 'success' END AS state, ts AS started_at
FROM events"""

VIEWS["jobs"] = """
SELECT event_id AS job_id, CAST(user_id % 20 AS INT) AS connection_id,
  CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'click' THEN 'running' ELSE 'succeeded' END AS status, ts AS started_at
FROM events"""

VIEWS["task_logs"] = """
SELECT conv_id * 1000 + turn AS log_id, text || chr(10) || 'ERROR step ' || turn || chr(10) || 'Exception: ' ||
  ['Connection refused', 'Table raw.x doesn''t exist', 'Authentication failed', 'No module named foo', '429 rate limit',
   'Out of memory', 'all good'][(conv_id + turn) % 7 + 1] || chr(10) || 'leaving' AS log
FROM conversations"""

VIEWS["table_counts"] = """
SELECT CAST(ts AS DATE) AS run_date, event_type AS table_name, count(*) AS row_count, 'saas' AS pipeline
FROM events GROUP BY 1, 2"""

VIEWS["bronze_customers"] = """
SELECT customer_id, first_name, last_name, lower(email) AS email, phone, segment, country, city, created_at, updated_at,
  _ab_cdc_deleted_at, _airbyte_extracted_at
FROM raw_customers WHERE customer_id IS NOT NULL AND (_ab_cdc_deleted_at IS NULL OR _ab_cdc_deleted_at = '')"""

VIEWS["bronze_orders"] = """
SELECT order_id, customer_id, product_id, CAST(amount AS DECIMAL(18,2)) AS amount, quantity, status, order_date, updated_at,
  _ab_cdc_deleted_at, _airbyte_extracted_at
FROM raw_orders WHERE order_id IS NOT NULL AND (_ab_cdc_deleted_at IS NULL OR _ab_cdc_deleted_at = '')"""

VIEWS["bronze_products"] = """
SELECT product_id, name, category, CAST(price AS DECIMAL(18,2)) AS price, CAST(stock_qty AS INT) AS stock_qty, sku, created_at,
  updated_at, _ab_cdc_deleted_at, _airbyte_extracted_at
FROM raw_products WHERE product_id IS NOT NULL AND (_ab_cdc_deleted_at IS NULL OR _ab_cdc_deleted_at = '')"""

VIEWS["stg_customers"] = f"""
SELECT customer_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
  trim(first_name) || ' ' || trim(last_name) AS full_name, lower(trim(email)) AS email, {BLANK.format('phone')} AS phone,
  CASE WHEN upper(segment) IN ('B2B', 'B2C', 'VIP') THEN upper(segment) ELSE 'B2C' END AS segment,
  upper(trim(country)) AS country, {BLANK.format('city')} AS city, created_at, updated_at,
  CAST(created_at AS DATE) AS created_date, CAST(DATE '2001-08-01' - CAST(created_at AS DATE) AS INT) AS days_since_signup
FROM bronze_customers WHERE customer_id > 0 AND email <> '' AND email LIKE '%@%'
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1"""

VIEWS["stg_orders"] = """
SELECT order_id, customer_id, product_id, amount, quantity,
  CASE WHEN lower(status) IN ('pending', 'completed', 'cancelled') THEN lower(status) ELSE 'pending' END AS status,
  order_date, updated_at, CAST(order_date AS DATE) AS order_date_day, CAST(date_trunc('month', order_date) AS DATE) AS order_month,
  CAST(year(order_date) AS INT) AS order_year,
  CASE WHEN lower(status) = 'completed' THEN amount ELSE CAST(0 AS DECIMAL(18,2)) END AS revenue
FROM bronze_orders WHERE order_id > 0 AND customer_id > 0 AND product_id > 0 AND amount > 0
QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY updated_at DESC) = 1"""

VIEWS["stg_products"] = f"""
SELECT product_id, trim(name) AS name, {TITLE.format('category')} AS category, price, greatest(stock_qty, 0) AS stock_qty,
  upper(trim(sku)) AS sku, CASE WHEN price < 50 THEN 'Budget' WHEN price < 200 THEN 'Mid-range' WHEN price < 500 THEN 'Premium'
  ELSE 'Luxury' END AS price_tier, created_at, updated_at
FROM bronze_products WHERE product_id > 0 AND price > 0 AND name <> ''
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY updated_at DESC) = 1"""

VIEWS["stg_vendors"] = f"""
SELECT vendor_id, trim(name) AS name, trim(contact_name) AS contact_name, lower(trim(email)) AS email,
  {BLANK.format('phone')} AS phone, upper(trim(country)) AS country, {BLANK.format('city')} AS city,
  {TITLE.format('category')} AS category, upper(trim(payment_terms)) AS payment_terms, CAST(is_active AS INT) AS is_active,
  created_at, updated_at
FROM raw_vendors WHERE vendor_id <> '' AND name <> ''"""

VIEWS["stg_purchase_orders"] = """
SELECT po_id, vendor_id, CAST(amount AS DECIMAL(18,2)) AS amount, upper(trim(currency)) AS currency,
  CASE WHEN upper(status) IN ('OPEN', 'APPROVED', 'RECEIVED', 'CLOSED', 'CANCELLED') THEN upper(status) ELSE 'OPEN' END AS status,
  line_items, trim(description) AS description, trim(requested_by) AS requested_by, po_date, delivery_date, created_at, updated_at,
  CAST(po_date AS DATE) AS po_date_day, CAST(date_diff('day', po_date, delivery_date) AS INT) AS lead_time_days,
  CASE WHEN upper(status) IN ('CLOSED', 'RECEIVED') THEN CAST(amount AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END AS fulfilled_amount
FROM raw_purchase_orders WHERE po_id <> '' AND vendor_id <> '' AND amount > 0"""

VIEWS["stg_reviews"] = """
SELECT post_id AS review_id, user_id, (post_id - 1) % 200 + 1 AS product_id, trim(title) AS summary, trim(body) AS review_text,
  post_id % 5 + 1 AS rating, TIMESTAMP '2024-01-31' AS created_at
FROM raw_posts WHERE post_id > 0 AND user_id > 0 AND body <> ''"""

VIEWS["stg_events"] = """
SELECT id AS event_id, user_id, event_type, page, occurred_at, CAST(occurred_at AS DATE) AS event_date
FROM raw_saas_events WHERE user_id IS NOT NULL"""

VIEWS["stg_subscriptions"] = """
SELECT id AS subscription_id, user_id, lower(plan) AS plan, amount AS mrr, billing_cycle, started_at, expires_at AS ended_at,
  lower(status) AS status
FROM raw_saas_subscriptions WHERE user_id IS NOT NULL"""

VIEWS["stg_users"] = """
SELECT id AS user_id, email, lower(plan) AS plan, mrr, lower(status) AS status, country, company, created_at, updated_at,
  CAST(DATE '2024-01-31' - CAST(created_at AS DATE) AS INT) AS days_since_signup
FROM raw_saas_users WHERE email <> '' AND id IS NOT NULL"""

VIEWS["dim_customers"] = """
SELECT md5(CAST(customer_id AS VARCHAR)) AS customer_key, customer_id, first_name, last_name, full_name, email, phone, segment,
  country, city, updated_at, days_since_signup, CAST(coalesce(epoch(updated_at), epoch(created_at), 0) AS BIGINT) AS version,
  created_at AS valid_from, TIMESTAMP '9999-12-31 23:59:59' AS valid_to, 1 AS is_current
FROM stg_customers"""

VIEWS["dim_products"] = """
SELECT md5(CAST(product_id AS VARCHAR)) AS product_key, product_id, name, category, price, price_tier,
  stock_qty AS current_stock_quantity, sku, CASE WHEN stock_qty = 0 THEN 0 ELSE 1 END AS is_in_stock, created_at, updated_at,
  CAST(epoch(updated_at) AS BIGINT) AS version
FROM stg_products"""

VIEWS["dim_vendors"] = """
SELECT md5(vendor_id) AS vendor_key, *, CAST(coalesce(epoch(updated_at), 0) AS BIGINT) AS version FROM stg_vendors"""

VIEWS["dim_users"] = """
SELECT u.user_id, email, u.plan, u.mrr, u.status, country, company, u.created_at, days_since_signup, billing_cycle, ended_at,
  CASE WHEN u.status = 'churned' THEN 1 ELSE 0 END AS is_churned, CASE WHEN u.plan = 'free' THEN 1 ELSE 0 END AS is_free
FROM stg_users u LEFT JOIN (SELECT * FROM stg_subscriptions
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY started_at DESC, subscription_id DESC) = 1) s ON u.user_id = s.user_id"""

VIEWS["fct_orders"] = """
SELECT o.order_id, md5(CAST(o.customer_id AS VARCHAR)) AS customer_key, md5(CAST(o.product_id AS VARCHAR)) AS product_key,
  o.customer_id, o.product_id, o.amount, o.quantity, o.revenue, o.status, o.order_date, o.order_date_day, o.order_month,
  o.order_year, o.updated_at, c.segment AS customer_segment, c.country AS customer_country, p.category AS product_category,
  p.price_tier AS product_price_tier, p.name AS product_name
FROM stg_orders o
LEFT JOIN dim_customers c ON md5(CAST(o.customer_id AS VARCHAR)) = c.customer_key AND c.is_current = 1
LEFT JOIN dim_products p ON md5(CAST(o.product_id AS VARCHAR)) = p.product_key"""

VIEWS["fct_procurement"] = """
SELECT po_id, md5(po.vendor_id) AS vendor_key, po.vendor_id, amount, fulfilled_amount, line_items, lead_time_days, status,
  currency, requested_by, description, po_date, po_date_day, delivery_date, po.updated_at, v.name AS vendor_name,
  v.country AS vendor_country, v.category AS vendor_category, payment_terms
FROM stg_purchase_orders po LEFT JOIN dim_vendors v ON md5(po.vendor_id) = v.vendor_key"""

VIEWS["fct_reviews"] = """
SELECT review_id, user_id, md5(CAST(r.product_id AS VARCHAR)) AS product_key, r.product_id, rating, summary, review_text,
  r.created_at, p.name AS product_name, p.category AS product_category, price_tier
FROM stg_reviews r LEFT JOIN dim_products p ON md5(CAST(r.product_id AS VARCHAR)) = p.product_key"""

VIEWS["fct_dau"] = """
SELECT event_date, count(DISTINCT user_id) AS dau, count(*) AS total_events, count(*) FILTER (event_type = 'login') AS logins,
  count(*) FILTER (event_type = 'signup') AS signups, count(*) FILTER (event_type = 'upgrade') AS upgrades,
  count(*) FILTER (event_type = 'payment_failed') AS payment_failures
FROM stg_events GROUP BY event_date"""

VIEWS["fct_funnel"] = """
SELECT event_type, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
  CAST(min(occurred_at) AS DATE) AS first_seen, CAST(max(occurred_at) AS DATE) AS last_seen
FROM stg_events GROUP BY event_type"""

VIEWS["fct_mrr"] = """
SELECT plan, billing_cycle, count(*) AS total_subscribers, sum(mrr) AS total_mrr, avg(mrr) AS avg_mrr,
  count(*) FILTER (status = 'active') AS active_subscribers, count(*) FILTER (status = 'cancelled') AS churned_subscribers
FROM stg_subscriptions GROUP BY plan, billing_cycle"""

VIEWS["mart_enrichment"] = """
SELECT * FROM products_enriched QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY enriched_at DESC) = 1"""

VIEWS["unified"] = """
SELECT coalesce(c.email, u.email) AS email, customer_id, user_id, full_name, c.segment AS shopflow_segment,
  c.country AS shopflow_country, c.city AS shopflow_city, coalesce(n, 0) AS shopflow_order_count,
  coalesce(revenue, 0.0) AS total_shopflow_revenue, u.plan AS saas_plan, coalesce(u.mrr, 0.0) AS saas_mrr,
  u.status AS saas_status, u.company AS saas_company, u.country AS saas_country, coalesce(u.is_churned, 0) AS is_churned,
  CASE WHEN customer_id IS NOT NULL AND user_id IS NOT NULL THEN 'cross_domain' WHEN customer_id IS NOT NULL THEN 'shopflow_only'
       ELSE 'saas_only' END AS customer_type, TIMESTAMP '2001-08-01' AS profiled_at
FROM (SELECT d.*, n, revenue FROM dim_customers d LEFT JOIN
        (SELECT customer_key, count(*) AS n, CAST(sum(revenue) AS DOUBLE) AS revenue FROM fct_orders GROUP BY customer_key) a
        ON d.customer_key = a.customer_key WHERE is_current = 1) c
FULL OUTER JOIN dim_users u ON lower(trim(c.email)) = lower(trim(u.email))"""


def _mentioned(sql: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]


def with_views(sql: str) -> str:
    """The query preceded by the views it needs, in definition order."""
    needed: set[str] = set()
    todo = _mentioned(sql)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += [n for n in _mentioned(VIEWS[name]) if n != name]
    if not needed:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in needed)
    body = sql.strip()
    if body.startswith("WITH "):
        body = ", " + body.removeprefix("WITH ")
    return f"WITH {views}\n{body}"
