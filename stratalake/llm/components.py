"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.tables import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows ``(u, root)`` for every node ``u`` of the edges ``(u, v)`` that is not the smallest of its component.

    Each round joins every edge to the smallest neighbour of its end; sums per node combine in the map tasks, so a node
    with very many neighbours costs no large group. The edges of a round are a written table. Ends after a number of
    rounds in the order of the logarithm of the longest path. Loops and repeated edges are ignored; no edges give no rows.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    pairs = stored(pairs, "edges")
    before = _state(pairs)
    while before[0]:
        both = pairs.union(pairs.select("v", "u"))
        smallest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(smallest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        pairs = stored(small.select("e.u", "e.v").filter("u <> v").distinct(), "edges")
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs.withColumnRenamed("v", "root")
