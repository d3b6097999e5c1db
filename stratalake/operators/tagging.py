"""Text rules on messages and logs: intent, repeated questions, search, error classes. All row-wise and JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import contains_ci, question_key

# Key words per intent, weights and the order in which ties are broken.
INTENT_KEYWORDS: dict[str, list[str]] = {
    "self_healing": [
        "self heal", "self-heal", "self-healing", "auto fix", "auto repair", "autonomous fix", "heal automatically",
        "fix automatically", "auto-fix", "auto-heal", "auto-diagnose", "heal the", "autonomously", "apply the fix", "apply fix",
    ],
    "anomaly": [
        "anomaly detection", "unusual pattern", "detect anomaly", "contextual anomaly", "pipeline trend", "pattern analysis",
        "run history", "detect unusual", "trend analysis", "duration spike", "consecutive failure", "anomaly", "anomalies",
    ],
    "nl_dbt": [
        "generate model", "create dbt model", "write dbt", "build metric", "new dbt model", "generate sql for",
        "create a model", "write a model", "build a dbt", "a dbt model", "generate a dbt", "build a new dbt",
        "dbt model for", "new model for", "loyal customers", "rolling revenue", "rolling window", "dim_loyal",
    ],
    "contract": [
        "data contract", "generate expectation", "auto contract", "create expectation", "contract engine",
        "expectation suite", "generate rules", "auto generate rules", "great expectations suite", "ge suite",
        "audit-ready", "governance auditor", "scd2 integrity",
    ],
    "airbyte": [
        "airbyte", "connector", "sync job", "source connector", "destination connector", "abctl", "airbyte connection",
    ],
    "ingestion": [
        "minio", "ingest", "landed", "parquet", "raw bucket", "mysql cdc", "sap api", "rest api", "file landing",
        "bronze layer", "s3 view", "files missing", "not landed", "kafka", "streaming", "debezium", "enrichment pipeline",
    ],
    "quality": [
        "data quality", "dbt test", "freshness", "great expectations", "orphan", "integrity", "health check", "how healthy",
        "null check", "null rate", "null rates", "null values", "missing values", "missing data", "column null",
        "data completeness", "highest null", "completeness check", "null count", "data gaps", "stale data",
        "row count check", "duplicate check", "uniqueness check",
    ],
    "orchestration": [
        "airflow", "dag", "failed", "broken", "pipeline", "task", "heal", "restart", "trigger", "scheduled", "dag run",
        "task instance", "backfill", "last run", "pipeline status", "did it run", "when did", "schema evolution dag",
        "auto contract dag", "streaming enrichment dag",
    ],
    "performance": [
        "slow", "performance", "optimize", "archive", "query time", "memory usage", "disk usage", "bottleneck", "latency",
        "storage size", "table size", "how big", "disk space", "storage", "disk", "ttl", "codec", "compression",
        "largest table", "most storage", "reduce storage", "compressed", "table bytes", "disk footprint", "column usage",
        "unused column", "deprecated column", "never queried", "query traffic", "column_usage_stats",
        "deprecation candidate", "which columns are used",
    ],
    "schema": [
        "schema", "column", "table structure", "describe", "what columns", "model sql", "data type", "primary key",
        "foreign key", "what fields", "definition", "stg_", "dim_", "fct_", "schema drift", "schema change",
        "column added", "new column", "sources.yml", "schema evolution", "schema snapshot", "column removed",
    ],
    "insight": [
        "revenue", "trend", "growth", "customer segment", "product category", "vendor spend", "mrr", "churn", "analytics",
        "kpi", "dashboard", "report", "forecast", "orders", "customers", "products", "sales", "dau", "active users",
        "saas", "subscription", "funnel", "unified", "cross-domain", "sentiment", "enriched", "category label",
        "quality tier", "product enrichment", "mart_product_enrichment", "positive product", "negative product",
        "premium product",
    ],
}
INTENT_WEIGHTS = {"self_healing": 3, "nl_dbt": 3, "contract": 2, "anomaly": 2}
INTENT_PRIORITY = [
    "self_healing", "nl_dbt", "contract", "anomaly", "airbyte", "quality", "orchestration", "performance", "schema",
    "ingestion", "insight",
]
DEFAULT_INTENT = "insight"

# Phrases of a log text and the class they mean, first match wins.
ERROR_RULES = [
    ("connection refused", "service_down"),
    ("doesn't exist", "missing_table"),
    ("authentication failed", "credentials"),
    ("no module named", "missing_module"),
    ("429", "rate_limit"),
    ("rate limit", "rate_limit"),
    ("out of memory", "memory"),
]
ERROR_WORDS = "ERROR|Exception|Error|Traceback"


def intent_scores(
    folded: Column, keywords: Mapping[str, Sequence[str]] = INTENT_KEYWORDS, weights: Mapping[str, int] = INTENT_WEIGHTS
) -> dict[str, Column]:
    """Weighted number of key words present in a text that is in lower case already, per intent."""

    def found(words: Sequence[str]) -> Column:
        present = [F.contains(folded, F.lit(w)).cast("int") for w in words]
        return sum(present[1:], present[0])

    return {intent: found(words) * weights.get(intent, 1) for intent, words in keywords.items()}


def tag_intent(
    messages: DataFrame,
    text: str = "content",
    keywords: Mapping[str, Sequence[str]] = INTENT_KEYWORDS,
    weights: Mapping[str, int] = INTENT_WEIGHTS,
    priority: Sequence[str] = tuple(INTENT_PRIORITY),
    default: str = DEFAULT_INTENT,
) -> DataFrame:
    """Add ``intent``: the best score, ties in the order of ``priority``, the default without any match.

    The key words are constants in the plan: no join, no shuffle, one scan of every whole text.
    """
    names = {intent: f"__score_{intent}" for intent in keywords}
    folded = messages.withColumn("__folded", F.lower(text))
    scored = folded.withColumns({names[i]: c for i, c in intent_scores(F.col("__folded"), keywords, weights).items()})
    scored = scored.withColumn("intent_score", F.greatest(*[F.col(n) for n in names.values()]))
    chosen = F.lit(default)
    for intent in reversed(priority):
        chosen = F.when(F.col(names[intent]) == F.col("intent_score"), F.lit(intent)).otherwise(chosen)
    tagged = scored.withColumn("intent", F.when(F.col("intent_score") == 0, F.lit(default)).otherwise(chosen))
    return tagged.drop("__folded", *names.values())


def search_messages(messages: DataFrame, session: str, needle: str, n: int = 20) -> DataFrame:
    """Newest messages of a session that contain a text, whatever its case."""
    hits = messages.filter((F.col("session_id") == session) & contains_ci(F.col("content"), needle))
    return hits.orderBy(F.desc("created_at"), F.desc("turn")).limit(n)


def with_question_key(messages: DataFrame) -> DataFrame:
    return messages.withColumn("question_key", question_key(F.col("agent"), F.col("content")))


def repeat_questions(messages: DataFrame) -> DataFrame:
    """Questions asked more than once: key, times, first and last time."""
    counted = with_question_key(messages).groupBy("question_key").agg(
        F.count("*").alias("times"), F.min("created_at").alias("first_asked"), F.max("created_at").alias("last_asked")
    )
    return counted.filter(F.col("times") > 1)


def classify_errors(logs: DataFrame, rules: Sequence[tuple[str, str]] = tuple(ERROR_RULES), text: str = "log") -> DataFrame:
    """Add ``error_class``: the class of the first rule whose phrase occurs, ``unknown`` without any."""
    folded = F.lower(text)
    found = F.lit("unknown")
    for phrase, name in reversed(rules):
        found = F.when(F.contains(folded, F.lit(phrase)), F.lit(name)).otherwise(found)
    return logs.withColumn("error_class", found)


def error_tail(logs: DataFrame, length: int = 500, text: str = "log") -> DataFrame:
    """Add the last line that reports an error and the last characters of the log."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(ERROR_WORDS))
    return logs.withColumns({"error_line": F.try_element_at(lines, F.lit(-1)), "tail": F.right(F.col(text), F.lit(length))})
