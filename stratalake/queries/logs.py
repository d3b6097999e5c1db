"""Operational logs, anomalies, text rules, neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from stratalake.operators import anomalies, neighbors, opslog, tagging, vector_index
from stratalake.queries.flows import table_files
from stratalake.queries.registry import query
from stratalake.sources.driver_tables import AGENTS, EVENTS_AS_OF

# ---- cost --------------------------------------------------------------------------------------------

query(
    "ops1_compute_cost",
    "SELECT * REPLACE (CAST(input_cost AS DOUBLE) AS input_cost, CAST(output_cost AS DOUBLE) AS output_cost, CAST(total_cost AS DOUBLE) AS total_cost) FROM priced_calls",
)(lambda t: opslog.compute_cost(t.calls))
TOTALS = """count(*) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, CAST(sum(output_tokens) AS BIGINT) AS output_tokens,
  CAST(sum(total_cost) AS DOUBLE) AS total_cost, avg(latency_ms) AS avg_latency_ms"""
query(
    "ops2_daily_costs",
    f"""SELECT CAST(created_at AS DATE) AS day, agent, {TOTALS} FROM priced_calls
      WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 14 DAY GROUP BY 1, 2""",
)(lambda t: opslog.daily_costs(t.calls, 14, EVENTS_AS_OF))
query(
    "ops3_cost_summary",
    f"""SELECT agent, {TOTALS}, min(created_at) AS first_call, max(created_at) AS last_call FROM priced_calls
      WHERE created_at >= TIMESTAMP '2024-01-31' - INTERVAL 30 DAY GROUP BY GROUPING SETS ((), (agent))""",
)(lambda t: opslog.cost_summary(t.calls, 30, EVENTS_AS_OF))
query("ops4_recent_calls", "SELECT * FROM calls ORDER BY created_at DESC, id DESC LIMIT 50")(
    lambda t: opslog.recent(t.calls, 50, "created_at", "id")
)
INCIDENTS = """WITH incidents AS (SELECT event_id AS id, 'user_' || user_id AS entity, 'error ' || json_extract_string(props, '$.k') AS problem,
  CASE WHEN value < 50 THEN 'retried' END AS action_taken, coalesce(value < 50, false) AS resolved, ts AS created_at FROM events WHERE event_type = 'error')"""
query("ops4_recent_incidents", INCIDENTS + " SELECT * EXCLUDE (id) FROM incidents ORDER BY created_at DESC, id DESC LIMIT 10")(
    lambda t: opslog.recent_incidents(t.incidents)
)
query(
    "ops4_open_incidents",
    INCIDENTS
    + """ SELECT entity, count(*) AS unresolved, max(created_at) AS last_at, arg_max(problem, (created_at, id)) AS last_problem
      FROM incidents WHERE NOT resolved GROUP BY 1""",
)(lambda t: opslog.open_incidents(t.incidents))
PIVOT = ", ".join(f"coalesce(CAST(sum(total_cost) FILTER (agent = '{a}') AS DOUBLE), 0.0) AS {a}" for a in AGENTS)
query("ops10_cost_pivot", f"SELECT CAST(created_at AS DATE) AS day, {PIVOT} FROM priced_calls GROUP BY 1")(
    lambda t: opslog.cost_pivot(t.calls, AGENTS)
)
query(
    "ops11_cost_share",
    """SELECT agent, total_cost, round(total_cost / sum(total_cost) OVER () * 100, 4) AS share_pct
      FROM (SELECT agent, CAST(sum(total_cost) AS DOUBLE) AS total_cost FROM priced_calls GROUP BY 1)""",
)(lambda t: opslog.cost_share(t.calls))

# ---- queries and storage -----------------------------------------------------------------------------


def _size_sql(value: str) -> str:
    """Readable size of a byte count."""
    return f"""CASE WHEN {value} >= 1099511627776 THEN printf('%.2f TiB', {value} / 1099511627776.0)
      WHEN {value} >= 1073741824 THEN printf('%.2f GiB', {value} / 1073741824.0)
      WHEN {value} >= 1048576 THEN printf('%.2f MiB', {value} / 1048576.0)
      WHEN {value} >= 1024 THEN printf('%.2f KiB', {value} / 1024.0) ELSE printf('%.2f B', CAST({value} AS DOUBLE)) END"""


query(
    "ops5_slow_queries",
    f"""SELECT query_id, query_duration_ms, read_rows, {_size_sql('memory_usage')} AS memory, substring(query, 1, 100) AS query_snippet,
      'SLOW' AS band FROM query_log WHERE CAST(event_time AS DATE) = DATE '2024-01-31' AND type = 'QueryFinish'
      AND query_duration_ms > 1000 ORDER BY query_duration_ms DESC, query_id LIMIT 5""",
)(lambda t: opslog.slow_queries(t.query_log, EVENTS_AS_OF))
query(
    "ops5_slow_initial_queries",
    f"""SELECT query_id, CAST(round(query_duration_ms / 1000.0, 2) AS DOUBLE) AS seconds, {_size_sql('read_bytes')} AS bytes_read, read_rows
      FROM query_log WHERE event_time BETWEEN TIMESTAMP '2024-01-31 00:00:00' AND TIMESTAMP '2024-01-31 12:00:00' AND type = 'QueryFinish'
      AND is_initial_query = 1 AND query_duration_ms > 500 ORDER BY seconds DESC, query_id LIMIT 10""",
)(lambda t: opslog.slow_initial_queries(t.query_log, "2024-01-31 12:00:00", hours=12))


def _ops6(t):
    """Text bytes per document source against the bytes of one character per letter."""
    sizes = t.table("documents").select(
        F.col("source").alias("table_name"),
        F.col("n_chars").alias("stored"),
        F.octet_length("text").cast("bigint").alias("raw"),
    )
    return opslog.storage_report(sizes)


query(
    "ops6_storage_report",
    f"""SELECT table_name, stored, raw, {_size_sql('stored')} AS stored_size, {_size_sql('raw')} AS raw_size,
      round(CAST(stored AS DOUBLE) * 100 / greatest(raw, 1), 1) AS ratio_pct, CASE WHEN stored < 500 * 1048576 THEN 'OK' WHEN stored <= 1073741824 THEN 'MONITOR' ELSE 'ARCHIVE' END AS band FROM (SELECT source AS table_name,
      CAST(sum(n_chars) AS BIGINT) AS stored, CAST(sum(strlen(text)) AS BIGINT) AS raw FROM documents GROUP BY 1)""",
)(_ops6)
query("ops6_file_sizes")(
    lambda t: opslog.storage_report(
        table_files(t).select(F.col("prefix").alias("table_name"), F.col("length").alias("stored"), F.col("length").alias("raw"))
    )
)

# ---- runs --------------------------------------------------------------------------------------------

query(
    "ops7_run_history",
    """SELECT dag_id, dag_run_id, state, start_date, CAST(duration_min AS DOUBLE) AS duration_min FROM timed_runs
      QUALIFY row_number() OVER (PARTITION BY dag_id ORDER BY start_date DESC, dag_run_id DESC) <= 30""",
)(lambda t: opslog.run_history(t.runs, 30))
query(
    "ops8_sync_health",
    """SELECT * FROM (SELECT n_nationkey AS connection_id, n_name AS name, job_id, status, CASE WHEN job_id IS NULL THEN 'no job history'
      WHEN status NOT IN ('succeeded', 'running', 'pending') THEN 'failed' END AS problem FROM nation LEFT JOIN (SELECT * FROM jobs
      QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY started_at DESC, job_id DESC) = 1) j ON connection_id = n_nationkey)
      WHERE problem IS NOT NULL""",
)(lambda t: opslog.sync_health(t.connections, t.jobs))
query(
    "ops9_tally_results",
    """, s AS (SELECT CAST(ts AS DATE) AS run_date, unnest([['pass', 'success', 'warn', 'error', 'fail', 'skipped'][event_id % 6 + 1],
        ['pass', 'success', 'warn', 'error', 'fail', 'skipped'][event_id % 5 + 1]]) AS status FROM events)
      SELECT run_date, count(*) FILTER (status IN ('pass', 'success')) AS pass, count(*) FILTER (status = 'warn') AS warn,
        count(*) FILTER (status IN ('error', 'fail')) AS error, count(*) FILTER (status = 'skipped') AS skip, count(*) AS total
      FROM s GROUP BY 1""".replace(", s AS", "WITH s AS", 1),
)(lambda t: opslog.tally_results(t.test_results, ["run_date"]))
query(
    "ops12_sla_misses",
    "SELECT dag_id, dag_run_id, CAST(duration_min AS DOUBLE) AS duration_min FROM timed_runs WHERE duration_min > 30",
)(lambda t: opslog.sla_misses(t.runs))

# ---- anomalies ---------------------------------------------------------------------------------------


def _daily_orders(t):
    return t.table("orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("value"))


WEEKDAY = """, daily AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS value FROM orders GROUP BY 1),
  based AS (SELECT *, avg(value) OVER (PARTITION BY dayofweek(day) ORDER BY day ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS baseline FROM daily),
  off AS (SELECT *, round((value - baseline) * CAST(100.0 AS DOUBLE) / baseline, 2) AS deviation_pct FROM based),
  flagged AS (SELECT *, coalesce(abs(deviation_pct) > 25, false) AS is_anomaly FROM off)""".replace(", daily", "WITH daily", 1)
query("ano1_weekday_anomaly", WEEKDAY + " SELECT * FROM flagged")(lambda t: anomalies.weekday_anomaly(_daily_orders(t)))
query("win8_weekday_baseline", WEEKDAY + " SELECT day, value, baseline FROM flagged")(
    lambda t: anomalies.weekday_anomaly(_daily_orders(t)).select("day", "value", "baseline")
)
query(
    "ano2_duration_anomaly",
    """, done AS (SELECT *, CAST(start_date AS DATE) AS day FROM timed_runs WHERE duration_min IS NOT NULL),
      days AS (SELECT DISTINCT dag_id, day FROM done),
      base AS (SELECT d.dag_id, d.day, sum(CAST(round(r.duration_min * 10) AS BIGINT)) / (count(*) * 10) AS mean_min FROM days d JOIN done r ON r.dag_id = d.dag_id
        AND r.day BETWEEN d.day - 7 AND d.day - 1 GROUP BY 1, 2)
      SELECT r.dag_id, dag_run_id, CAST(duration_min AS DOUBLE) AS duration_min, mean_min FROM done r JOIN base b ON r.dag_id = b.dag_id
        AND r.day = b.day WHERE CAST(duration_min AS DOUBLE) > mean_min * 2""",
)(lambda t: anomalies.duration_anomaly(t.runs))
query(
    "ano3_failure_streaks",
    """, numbered AS (SELECT *, row_number() OVER (PARTITION BY dag_id ORDER BY start_date, dag_run_id) -
        row_number() OVER (PARTITION BY dag_id, state = 'failed' ORDER BY start_date, dag_run_id) AS island FROM runs)
      SELECT dag_id, count(*) AS failures, min(start_date) AS first_failure, max(start_date) AS last_failure FROM numbered
      WHERE state = 'failed' GROUP BY dag_id, island HAVING count(*) >= 3""",
)(lambda t: anomalies.failure_streaks(t.runs))
query(
    "ano4_suppress_expected",
    WEEKDAY
    + """, firsts AS (SELECT *, min(day) OVER (PARTITION BY date_trunc('month', day)) AS first_day FROM flagged)
      SELECT day, value, baseline, deviation_pct, is_anomaly, is_anomaly AND coalesce((dayofweek(day) IN (0, 6) AND
        -deviation_pct BETWEEN 15 AND 30) OR (day = first_day AND deviation_pct > 0), false) AS suppressed FROM firsts""",
)(lambda t: anomalies.suppress_expected(anomalies.weekday_anomaly(_daily_orders(t))))
query(
    "ano5_failure_loops",
    """SELECT run_id, task_id, count(*) FILTER (state = 'failed') AS failures FROM task_tries GROUP BY 1, 2
      HAVING count(*) FILTER (state = 'failed') >= 3""",
)(lambda t: anomalies.failure_loops(t.task_tries))

# ---- text --------------------------------------------------------------------------------------------


def _score_sql(intent: str) -> str:
    listed = ", ".join("'" + w.replace("'", "''") + "'" for w in tagging.INTENT_KEYWORDS[intent])
    weight = tagging.INTENT_WEIGHTS.get(intent, 1)
    return f"len([k for k in [{listed}] if contains(msg, k)]) * {weight} AS {intent}"


INTENT_SQL = f""", scored AS (SELECT session_id, turn, {', '.join(_score_sql(i) for i in tagging.INTENT_KEYWORDS)}
    FROM (SELECT *, lower(content) AS msg FROM messages)),
  best AS (SELECT *, greatest({', '.join(tagging.INTENT_KEYWORDS)}) AS top FROM scored)
  SELECT session_id, turn, CAST(top AS INT) AS intent_score, CASE WHEN top = 0 THEN 'insight'
    {' '.join(f"WHEN {i} = top THEN '{i}'" for i in tagging.INTENT_PRIORITY)} END AS intent FROM best"""
query("txt1_tag_intent", INTENT_SQL)(
    lambda t: tagging.tag_intent(t.messages).select("session_id", "turn", "intent_score", "intent")
)
query(
    "txt2_search_messages",
    "SELECT * FROM messages WHERE session_id = '1' AND content ILIKE '%Q%' ORDER BY created_at DESC, turn DESC LIMIT 20",
)(lambda t: tagging.search_messages(t.messages, "1", "Q"))
KEY = "md5(agent || ':' || lower(trim(content)))"
query("txt3_question_key", f"SELECT *, {KEY} AS question_key FROM messages")(lambda t: tagging.with_question_key(t.messages))


def _asked(t):
    """Documents as questions: exact copies of a text are repeated questions."""
    return t.table("documents").select(
        F.col("lang").alias("agent"), F.col("text").alias("content"), F.timestamp_seconds("doc_id").alias("created_at")
    )


query(
    "txt3_repeat_questions",
    """SELECT md5(lang || ':' || lower(trim(text))) AS question_key, count(*) AS times,
      TIMESTAMP '1970-01-01' + to_seconds(min(doc_id)) AS first_asked, TIMESTAMP '1970-01-01' + to_seconds(max(doc_id)) AS last_asked
      FROM documents GROUP BY 1 HAVING count(*) > 1""",
)(lambda t: tagging.repeat_questions(_asked(t)))
CLASSES = " ".join("WHEN contains(lower(log), '" + p.replace("'", "''") + f"') THEN '{c}'" for p, c in tagging.ERROR_RULES)
query("txt4_classify_errors", f"SELECT log_id, CASE {CLASSES} ELSE 'unknown' END AS error_class FROM task_logs")(
    lambda t: tagging.classify_errors(t.task_logs).select("log_id", "error_class")
)
query(
    "txt5_error_tail",
    """SELECT log_id, list_filter_last AS error_line, right(log, 500) AS tail FROM (SELECT *, [x for x in string_split(log, chr(10))
      if regexp_matches(x, 'ERROR|Exception|Error|Traceback')][-1] AS list_filter_last FROM task_logs)""",
)(lambda t: tagging.error_tail(t.task_logs).select("log_id", "error_line", "tail"))

# ---- neighbours --------------------------------------------------------------------------------------

MAX_DIST = 3.0
K = 10


def _centroids(t):
    """One query per label: the mean vector of all its rows."""
    cells = t.table("embeddings").select("label", F.posexplode("embedding").alias("place", "x"))
    means = cells.groupBy("label", "place").agg(F.avg(F.col("x").cast("double")).alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("place", "x")))  # one entry per dimension
    grouped = means.groupBy("label").agg(ordered.alias("cells"))
    return grouped.select(F.col("label").cast("bigint").alias("query_id"), F.transform("cells", lambda c: c["x"]).alias("embedding"))


def _rounded(df):
    return df.withColumn("distance", F.round("distance", 6))


def _asked_rows(t):
    """The stated queries: every row whose id is divisible by 50."""
    return t.table("embeddings").filter(F.col("vec_id") % 50 == 0).select(F.col("vec_id").cast("bigint").alias("query_id"), "embedding")


CENTROIDS = """WITH cells AS (SELECT label, generate_subscripts(embedding, 1) AS place, unnest(embedding) AS x FROM embeddings),
  q AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY place) AS v FROM (SELECT label, place, avg(CAST(x AS DOUBLE)) AS m
    FROM cells GROUP BY 1, 2) GROUP BY 1),"""
ASKED_ROWS = "WITH q AS (SELECT vec_id AS query_id, [CAST(x AS DOUBLE) for x in embedding] AS v FROM embeddings WHERE vec_id % 50 = 0),"
DISTANCES = """ d AS (SELECT query_id, vec_id, label, list_sum([pow(v[i] - CAST(embedding[i] AS DOUBLE), 2) for i in range(1, len(v) + 1)]) AS distance
    FROM q, embeddings),
  hits AS (SELECT query_id, vec_id, distance, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INT) AS rank
    FROM d QUALIFY rank <= 10)"""
NEAREST = f" SELECT query_id, vec_id, round(distance, 6) AS distance, rank FROM hits WHERE distance < {MAX_DIST}"
IN_CATEGORY = f""" SELECT query_id, vec_id, round(distance, 6) AS distance, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS INT) AS rank
      FROM d WHERE label = 1 AND distance < {MAX_DIST} QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) <= {K}"""
query("nn1_knn", ASKED_ROWS + DISTANCES + NEAREST)(lambda t: _rounded(neighbors.knn(_asked_rows(t), t.table("embeddings"), K, MAX_DIST)))
query("nn1_knn_centroids", CENTROIDS + DISTANCES + NEAREST)(lambda t: _rounded(neighbors.knn(_centroids(t), t.table("embeddings"), K, MAX_DIST)))
query("nn1_knn_category", ASKED_ROWS + DISTANCES + IN_CATEGORY)(
    lambda t: _rounded(neighbors.knn(_asked_rows(t), t.table("embeddings"), K, MAX_DIST, category=1))
)
query("nn1_index_exact", ASKED_ROWS + DISTANCES + NEAREST)(
    lambda t: _rounded(vector_index.search(vector_index.build_index(t.table("embeddings")), _asked_rows(t), K, MAX_DIST, exact=True))
)


def _index_recall(t):
    """The probing search against the exact one."""
    queries, corpus = _asked_rows(t), t.table("embeddings")
    found = vector_index.search(vector_index.build_index(corpus), queries, K, MAX_DIST)
    measured = vector_index.recall(found, neighbors.knn(queries, corpus, K, MAX_DIST))
    return measured.select("queries", "expected", (F.col("recall") >= 0.9).alias("recall_of_nine_tenths"))


query(
    "nn1_index_recall",
    ASKED_ROWS + DISTANCES + f" SELECT count(DISTINCT query_id) AS queries, count(*) AS expected, true AS recall_of_nine_tenths FROM hits WHERE distance < {MAX_DIST}",
)(_index_recall)


def _variants(t):
    """Two variants per question: the vector of a row and the same moved towards the origin."""
    base = _asked_rows(t)
    scaled = lambda f: F.transform("embedding", lambda x: x * f)
    one = base.select(F.col("query_id").alias("question_id"), (F.col("query_id") * 2).alias("query_id"), F.lit(0).alias("variant"), "embedding")
    two = base.select(F.col("query_id").alias("question_id"), (F.col("query_id") * 2 + 1).alias("query_id"), F.lit(1).alias("variant"), scaled(0.5).alias("embedding"))
    return one.unionByName(two)


query(
    "nn2_knn_multi",
    ASKED_ROWS
    + DISTANCES
    + """, variants AS (SELECT query_id AS question_id, 0 AS variant, v FROM q UNION ALL SELECT query_id, 1, [x * 0.5 for x in v] FROM q),
      dist AS (SELECT question_id, variant, vec_id, list_sum([pow(v[i] - CAST(embedding[i] AS DOUBLE), 2) for i in range(1, len(v) + 1)])
        AS distance FROM variants, embeddings),
      cand AS (SELECT *, CAST(row_number() OVER (PARTITION BY question_id, variant ORDER BY distance, vec_id) AS INT) AS rank FROM dist QUALIFY rank <= 7),
      uniq AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY question_id, vec_id ORDER BY variant, rank) = 1)
      SELECT question_id, vec_id, CAST(variant AS INT) AS variant, rank, round(distance, 6) AS distance FROM uniq
      QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY variant, rank, vec_id) <= 7""",
)(lambda t: _rounded(neighbors.knn_multi(_variants(t), t.table("embeddings"), 5)))


def _nn3(t):
    """Vendors one purchase away from the hits: vendors that ship the same part."""
    lines = t.table("lineitem").select("l_orderkey", "l_suppkey").distinct()
    hits = t.table("supplier").select(F.col("s_nationkey").cast("bigint").alias("query_id"), F.col("s_suppkey").alias("node"))
    edges = lines.select(F.col("l_suppkey").alias("src"), (F.col("l_orderkey") % 100).alias("dst")).distinct()
    return neighbors.expand_neighbors(hits, edges)


query(
    "nn3_expand_neighbors",
    """SELECT DISTINCT CAST(s_nationkey AS BIGINT) AS query_id, l_orderkey % 100 AS node FROM supplier JOIN lineitem ON l_suppkey = s_suppkey
      WHERE NOT EXISTS (SELECT 1 FROM supplier s2 WHERE s2.s_nationkey = supplier.s_nationkey AND s2.s_suppkey = lineitem.l_orderkey % 100)""",
)(_nn3)
