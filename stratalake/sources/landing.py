"""Shaping of extracted rows before they are landed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.dates import as_timestamp


def incremental_since(df: DataFrame, cursor, ts: str = "updated_at") -> DataFrame:
    """Rows changed after the cursor (all rows when there is none)."""
    return df if cursor is None else df.filter(F.col(ts) > as_timestamp(cursor))


def next_cursor(df: DataFrame, ts: str = "updated_at") -> DataFrame:
    """One row with the cursor for the next extract."""
    return df.agg(F.max(ts).alias("next_cursor"))


def extract_limited(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows in key order: a bounded sample landing."""
    return df.orderBy(key).limit(n)


def null_defaults(df: DataFrame, rules: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a default per column; timestamps take a text default."""
    fixed = {}
    for name, default in rules.items():
        kind = df.schema[name].dataType
        fixed[name] = F.coalesce(F.col(name), F.lit(default).cast(kind))
    return df.withColumns(fixed)


def with_load_metadata(df: DataFrame, extracted_at, sync_id: str) -> DataFrame:
    """Extraction time, sync id and the two empty change-capture columns."""
    return df.withColumns(
        {
            "_ab_cdc_deleted_at": F.lit(None).cast("string"),
            "_ab_cdc_lsn": F.lit(None).cast("string"),
            "_airbyte_extracted_at": as_timestamp(extracted_at),
            "_airbyte_sync_id": F.lit(sync_id),
        }
    )


def flatten_nested(df: DataFrame) -> DataFrame:
    """Nested columns to JSON text, timestamps to ISO text; flat columns stay."""

    def flat(field: T.StructField):
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StructType, T.MapType, T.ArrayType)):
            col = F.to_json(col)
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
        return col.alias(field.name)

    return df.select([flat(f) for f in df.schema.fields])
