"""Relational extracts. A read is split over executors by ranges of a numeric column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Bounds:
    """How a table is split: values of ``column`` from ``lower`` to ``upper`` in ``partitions`` ranges."""

    column: str
    lower: int
    upper: int
    partitions: int


@dataclass(frozen=True)
class JdbcSource:
    url: str
    driver: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 10_000

    def options(self, table: str, bounds: Bounds | None = None) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": table, "fetchsize": str(self.fetch_size), **self.properties}
        if self.driver:
            opts["driver"] = self.driver
        if bounds:
            opts |= {
                "partitionColumn": bounds.column,
                "lowerBound": str(bounds.lower),
                "upperBound": str(bounds.upper),
                "numPartitions": str(bounds.partitions),
            }
        return opts


def jdbc_extract(spark: SparkSession, source: JdbcSource, table: str, bounds: Bounds | None = None) -> DataFrame:
    """Whole table, read in parallel ranges and in key order inside each range when bounds are given."""
    df = spark.read.format("jdbc").options(**source.options(table, bounds)).load()
    return df.sortWithinPartitions(bounds.column) if bounds else df


def jdbc_query(spark: SparkSession, source: JdbcSource, sql: str, bounds: Bounds | None = None) -> DataFrame:
    """Result of a query that runs at the source; filters and columns put on top are pushed down as well."""
    return spark.read.format("jdbc").options(**source.options(f"({sql}) t", bounds)).load()


def jdbc_replace(df: DataFrame, source: JdbcSource, table: str, batch_size: int = 10_000) -> None:
    """Truncate the table at the source, then append in batches (keeps the table's definition)."""
    opts = source.options(table) | {"truncate": "true", "batchsize": str(batch_size)}
    df.write.format("jdbc").options(**opts).mode("overwrite").save()
