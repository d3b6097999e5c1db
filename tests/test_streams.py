"""Streams give what the batch form gives, whatever the split into micro-batches."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratalake.session import scratch_path
from stratalake.streaming import cdc, enrichment, events

AT = "2024-01-01 00:00:00"
MESSAGES = [
    (0, '{"product_id":1,"name":"pen","category":"A","price":10.0}'),
    (1, '{"schema":{},"payload":{"product_id":2,"name":"ring","category":"B","price":150.0}}'),
    (2, '{"id":3,"name":null,"category":"C","price":50.0}'),
    (3, '"just text"'),
    (4, "[1,2]"),
    (5, "not json"),
    (6, '{"product_id":1,"name":"pen2","category":"A","price":120.0}'),
]


@pytest.fixture
def landed(spark):
    path = scratch_path(spark, "messages")
    for offset, value in MESSAGES:
        spark.createDataFrame([(offset, value)], cdc.MESSAGE).coalesce(1).write.mode("append").parquet(path)
    return path


def names(df):
    return {r.product_id: (r.product_name, r.quality_tier) for r in df.collect()}


EXPECTED = {1: ("pen2", "premium"), 2: ("ring", "premium"), 3: ("", "standard")}


def test_non_objects_are_skipped_and_payload_unwrapped(spark):
    rows = cdc.unwrap_cdc(spark.createDataFrame(MESSAGES, cdc.MESSAGE))
    assert sorted(r.product_id for r in rows.collect()) == [1, 1, 2, 3]


@pytest.mark.parametrize("per_trigger", [None, 1, 3])
def test_stream_equals_batch(spark, landed, per_trigger):
    batch = enrichment.enrich_messages(spark.createDataFrame(MESSAGES, cdc.MESSAGE), AT)
    assert names(batch) == EXPECTED
    target, mart = scratch_path(spark, "target"), scratch_path(spark, "mart")
    run = cdc.foreach_batch_upsert(target, lambda df: enrichment.enrich_messages(df, AT), enrichment.refresh_mart(target, mart))
    source = cdc.StreamSource(path=landed, per_trigger=per_trigger)
    cdc.run_available(cdc.cdc_stream(spark, source), run, scratch_path(spark, "checkpoint"))
    assert names(cdc.read_target(spark, target, ["product_id"], "enriched_at")) == EXPECTED
    assert names(cdc.read_target(spark, mart, ["product_id"], "enriched_at")) == EXPECTED
    compacted = cdc.compact(spark, target, scratch_path(spark, "compact"), ["product_id"], "enriched_at")
    assert names(cdc.read_target(spark, compacted, ["product_id"], "enriched_at")) == EXPECTED


def test_replaying_a_batch_changes_nothing(spark):
    target = scratch_path(spark, "target")
    run = cdc.foreach_batch_upsert(target)
    batch = spark.createDataFrame([(1, "a")], "id int, value string")
    for _ in range(2):
        run(batch, 7)
    assert spark.read.parquet(target).count() == 1


def test_empty_batches_do_not_refresh(spark):
    calls = []
    run = cdc.foreach_batch_upsert(scratch_path(spark, "target"), after=lambda _, batch: calls.append(batch))
    df = spark.createDataFrame([(1,)], "id int")
    run(df.limit(0), 0)
    run(df, 1)
    assert calls == [1]


def test_broker_options():
    options = cdc.StreamSource(topic="t", servers="h:1", per_trigger=200).reader_options()
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "200"}


def test_failing_classifier_gives_defaults(spark):
    def refuse(products):
        raise RuntimeError("down")

    products = spark.createDataFrame([(1, "n", "A", 5.0), (2, "n", None, 500.0)], "product_id bigint, name string, category string, price double")
    out = {r.product_id: (r.sentiment, r.quality_tier, r.enriched_category, r.keywords) for r in enrichment.enrich_products(products, refuse).collect()}
    assert out == {1: ("neutral", "standard", "A", []), 2: ("neutral", "standard", "Unknown", [])}


def test_tags_are_cut_to_five(spark):
    raw = spark.createDataFrame([(1, "n", "A")], "product_id bigint, name string, category string")
    enriched = raw.select("product_id", F.lit("positive").alias("sentiment"), F.lit(None).cast("string").alias("quality_tier"), F.lit(None).cast("string").alias("enriched_category"), F.array(*[F.lit(str(i)) for i in range(8)]).alias("keywords"))
    row = enrichment.attach_raw(enriched, raw, AT).first()
    assert (row.keywords, row.quality_tier, row.enriched_category) == (["0", "1", "2", "3", "4"], "standard", "A")


def test_mart_merge_collapses_and_is_strict(spark):
    schema = "product_id bigint, product_name string, original_category string, enriched_category string, sentiment string, quality_tier string, keywords array<string>, enriched_at timestamp"
    row = lambda key, name, hour: (key, name, "A", "A", "neutral", "standard", [], dt.datetime(2024, 1, 1, hour))
    target = spark.createDataFrame([row(1, "old", 10)], schema)
    raw = spark.createDataFrame([row(1, "new", 11), row(2, "bound", 9), row(3, "a", 10), row(3, "b", 12)], schema)
    out = {r.product_id: r.product_name for r in enrichment.mart_product_enrichment(raw, target).collect()}
    assert out == {1: "new", 3: "b"}


EVENT = "event_id bigint, user_id bigint, event_type string, occurred_at timestamp"


def stream_of(spark, batches):
    path = scratch_path(spark, "events")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(path)


def test_late_events_count_within_the_watermark(spark):
    day = lambda d, h=1: dt.datetime(2024, 1, d, h)
    batches = [
        [(1, 1, "login", day(1)), (2, 2, "signup", day(1))],
        [(3, 1, "login", day(3)), (4, 1, "upgrade", day(1, 5))],
        [(5, 3, "login", day(9))],
        [(8, 3, "login", day(9, 1))],  # late rows are told by the watermark before the last batch
        [(6, 4, "login", day(2)), (7, 3, "login", day(9, 2))],
    ]
    target = scratch_path(spark, "target")
    stream = events.streaming_user_days(stream_of(spark, batches))
    cdc.run_available(stream, cdc.foreach_batch_upsert(target), scratch_path(spark, "checkpoint"), mode="update")
    out = {r.event_date.day: (r.dau, r.total_events, r.logins, r.upgrades) for r in events.read_dau(spark, target).collect()}
    assert out == {1: (2, 3, 1, 1), 3: (1, 1, 1, 0), 9: (1, 3, 3, 0)}


def test_copies_are_dropped_across_batches(spark):
    moment = dt.datetime(2024, 1, 1)
    rows = [(i, 1, "login", moment + dt.timedelta(minutes=i)) for i in range(10)]
    target = scratch_path(spark, "target")
    stream = events.streaming_dedup(stream_of(spark, [rows, rows[5:] + [(99, 1, "login", moment)]]))
    cdc.run_available(stream, cdc.foreach_batch_upsert(target), scratch_path(spark, "checkpoint"))
    assert sorted(r.event_id for r in spark.read.parquet(target).collect()) == [*range(10), 99]


def test_answers_are_handed_on_together_and_dealt_out(spark):
    def classify(products):
        if len(products) > 1 or products["price"].iloc[0] > 90:
            raise RuntimeError("one cheap product at a time")
        return products[["product_id"]].assign(sentiment="positive", quality_tier="standard", enriched_category=None, keywords=[["k"]])

    products = spark.range(100).coalesce(1).selectExpr("id AS product_id", "'n' AS name", "'A' AS category", "double(id) AS price")
    out = enrichment.enrich_products(products, classify, batch_size=1, tasks=8)
    assert out.rdd.getNumPartitions() == 8
    answers = {r.product_id: (r.sentiment, r.enriched_category, r.keywords) for r in out.collect()}
    assert answers == {i: ("neutral", "A", []) if i > 90 else ("positive", None, ["k"]) for i in range(100)}
    taken = lambda rows: [pd.DataFrame({"n": [len(r) for r in rows]})]
    batches = [r.n for r in enrichment.enrich_products(products, classify, batch_size=1).mapInPandas(taken, "n int").collect()]
    assert batches == [100]
