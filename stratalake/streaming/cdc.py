"""Change-stream sources and keyed, replay-safe sinks: every micro-batch is one load of a versioned table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratalake.functions.text import unwrap_payload
from stratalake.operators.dedup import dedup_latest
from stratalake.sources.versioned import BATCH, compact, read_target, write_batch

FLUSH_INTERVAL = "30 seconds"

__all__ = [
    "BATCH", "StreamSource", "cdc_stream", "compact", "foreach_batch_upsert", "latest_in_batch", "read_target", "run_available",
    "run_continuous", "unwrap_cdc", "write_batch",
]

MESSAGE = T.StructType([T.StructField("offset", T.LongType()), T.StructField("value", T.StringType())])
PRODUCT = T.StructType(
    [
        T.StructField("product_id", T.LongType()),
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("price", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class StreamSource:
    """Where messages come from: a broker topic, or a folder of landed message files."""

    topic: str | None = None
    servers: str | None = None
    path: str | None = None
    per_trigger: int | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        if self.topic:
            opts = {"kafka.bootstrap.servers": self.servers or "", "subscribe": self.topic, "startingOffsets": "earliest"}
            limit = "maxOffsetsPerTrigger"
        else:
            opts, limit = {}, "maxFilesPerTrigger"
        if self.per_trigger:
            opts[limit] = str(self.per_trigger)
        return opts | self.options


def cdc_stream(spark: SparkSession, source: StreamSource) -> DataFrame:
    """Messages as (offset, value) from the earliest one on."""
    if source.topic:
        raw = spark.readStream.format("kafka").options(**source.reader_options()).load()
        return raw.select("offset", F.col("value").cast("string").alias("value"))
    return spark.readStream.schema(MESSAGE).options(**source.reader_options()).parquet(source.path)


def unwrap_cdc(messages: DataFrame, row_schema: T.StructType = PRODUCT) -> DataFrame:
    """Rows of the messages; anything that is no JSON object or has no id is skipped. The id may be called ``id``."""
    rows = messages.select("offset", unwrap_payload(F.col("value"), row_schema).alias("row")).filter(F.col("row").isNotNull())
    flat = rows.select("offset", "row.*")
    if {"product_id", "id"} <= set(flat.columns):
        flat = flat.withColumn("product_id", F.coalesce("product_id", "id")).drop("id")
    return flat.filter(F.col("product_id").isNotNull()) if "product_id" in flat.columns else flat


def latest_in_batch(rows: DataFrame, key: str = "product_id", order: str = "offset") -> DataFrame:
    """Last image per id: the later message wins."""
    return dedup_latest(rows, [key], [order])


def foreach_batch_upsert(
    target: str, prepare: Callable[[DataFrame], DataFrame] | None = None, after: Callable[[SparkSession, int], None] | None = None
) -> Callable[[DataFrame, int], None]:
    """Batch function: prepare the rows, write them under the batch id, then run ``after`` if there were any.

    Emptiness is read from the written files, so the batch is computed once.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        write_batch(prepare(batch) if prepare else batch, target, batch_id)
        spark = batch.sparkSession
        if after and not spark.read.parquet(f"{target}/{BATCH}={batch_id}").isEmpty():
            after(spark, batch_id)

    return run


def run_available(stream: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that is there in bounded micro-batches, then stop. Progress is in the checkpoint."""
    writer = stream.writeStream.foreachBatch(function).outputMode(mode).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_continuous(
    stream: DataFrame, function: Callable[[DataFrame, int], None], checkpoint: str, interval: str = FLUSH_INTERVAL, mode: str = "append"
) -> StreamingQuery:
    """Keep processing: every interval, however few messages there are. The caller stops the query."""
    writer = stream.writeStream.foreachBatch(function).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=interval).start()
