"""Thresholded nearest neighbours of a set of query vectors, and expansion of hits along an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators.dedup import first_n

#: Corpus rows that a task holds at once, and queries matched with them at once.
SHARD_ROWS = 8_192
QUERY_ROWS = 64
HITS = "query_id bigint, vec_id bigint, distance double"


def _distances(queries: np.ndarray, corpus: np.ndarray, metric: str) -> np.ndarray:
    """Queries x corpus matrix: squared Euclidean or cosine distance."""
    if metric == "l2":
        out = np.empty((len(queries), len(corpus)))
        for i, q in enumerate(queries):
            gap = corpus - q
            out[i] = np.einsum("ij,ij->i", gap, gap)
        return out
    if metric == "cosine":
        unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
        return 1.0 - unit(queries) @ unit(corpus).T
    raise ValueError(f"metric {metric!r}: l2 or cosine")


def _best(query_ids, queries, ids, corpus, k: int, max_dist: float | None, metric: str) -> pd.DataFrame:
    """The k nearest corpus rows of every query within one block; equal distances in id order."""
    dist = _distances(queries, corpus, metric)
    found = []
    for row, query_id in enumerate(query_ids):
        near = np.arange(len(ids))
        if len(ids) > k:  # everything up to the k-th distance, ties included
            near = np.flatnonzero(dist[row] <= np.partition(dist[row], k - 1)[k - 1])
        best = near[np.lexsort((ids[near], dist[row][near]))[:k]]
        if max_dist is not None:
            best = best[dist[row][best] < max_dist]
        found.append(pd.DataFrame({"query_id": query_id, "vec_id": ids[best], "distance": dist[row][best]}))
    empty = pd.DataFrame({"query_id": np.array([], "int64"), "vec_id": np.array([], "int64"), "distance": np.array([])})
    return pd.concat([empty, *found], ignore_index=True)


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype("float64") if len(vectors) else np.empty((0, 0))


def _scan_shards(queries: DataFrame, corpus: DataFrame, k: int, max_dist, metric: str) -> DataFrame:
    """Every query against every corpus row, in blocks.

    The corpus is cut into shards of bounded size, each row going to one of them; every shard also gets all queries. A task holds
    one shard, which comes first in its rows, and passes the queries by it batch by batch, keeping k rows per query. The number
    of shards follows from the corpus' row count, which is a scalar of the same plan.
    """
    shards = F.greatest(F.lit(1), F.ceil(corpus.agg(F.count("*")).scalar() / F.lit(SHARD_ROWS)))
    number = F.pmod(F.xxhash64("vec_id"), shards)
    held = corpus.select(number.alias("shard"), F.col("vec_id").cast("bigint").alias("id"), "embedding")
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), shards - 1))
    asked = queries.select(every.alias("shard"), F.col("query_id").cast("bigint").alias("id"), "embedding")
    return scan_dealt(held, asked, k, max_dist, metric)


def scan_dealt(held: DataFrame, asked: DataFrame, k: int, max_dist: float | None, metric: str) -> DataFrame:
    """The k nearest held rows of every query within each shard; both sides are ``(shard, id, embedding)``."""
    vector = F.transform("embedding", lambda x: x.cast("double")).alias("embedding")
    kinds = [side.select("shard", F.lit(kind).alias("kind"), "id", vector) for kind, side in enumerate((held, asked))]
    dealt = kinds[0].unionByName(kinds[1]).repartition("shard").sortWithinPartitions("shard", "kind")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, ids, parts, block = None, [], [], None
        for batch in batches:
            for number, rows in batch.groupby("shard", sort=True):
                if number != shard:
                    shard, ids, parts, block = number, [], [], None
                corpus_rows, query_rows = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
                if len(corpus_rows):
                    ids.append(corpus_rows["id"].to_numpy("int64"))
                    parts.append(_matrix(corpus_rows["embedding"]))
                if len(query_rows) and ids:
                    if block is None:
                        block = np.concatenate(ids), np.concatenate(parts)
                    for at in range(0, len(query_rows), QUERY_ROWS):
                        some = query_rows.iloc[at : at + QUERY_ROWS]
                        yield _best(some["id"].to_numpy("int64"), _matrix(some["embedding"]), *block, k, max_dist, metric)

    return dealt.mapInPandas(scan, HITS)


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    max_dist: float | None = None,
    metric: str = "l2",
    category: int | str | None = None,
    category_col: str = "label",
) -> DataFrame:
    """Exact top-k per query with ``distance < max_dist``: (query_id, vec_id, distance, rank).

    ``queries`` has query_id and embedding, ``corpus`` vec_id and embedding. The corpus is read and shuffled once, whatever
    the number of queries.
    """
    if category is not None:
        corpus = corpus.filter(F.col(category_col) == category)
    scan = _scan_shards(queries, corpus, k, max_dist, metric)
    return ranked(scan, k)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k nearest hits per query; numbered only after at most k rows per query are left."""
    best = first_n(hits, ["query_id"], [F.col("distance"), F.col("vec_id")], k)
    return best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id")))


def candidates(n: int) -> int:
    """Number of candidates of the expanded search."""
    return max(n + 2, 4)


def knn_multi(variants: DataFrame, corpus: DataFrame, n: int, max_dist: float | None = None, metric: str = "l2") -> DataFrame:
    """Several query variants per question (question_id, query_id, variant, embedding): union of their hits,
    every document once at its best (variant, rank), at most n + 2 per question."""
    hits = knn(variants, corpus, candidates(n), max_dist, metric)
    tagged = hits.join(variants.select("query_id", "question_id", "variant"), "query_id")
    place = F.struct("variant", "rank")
    best = tagged.groupBy("question_id", "vec_id").agg(F.min(place).alias("place"), F.min_by("distance", place).alias("distance"))
    kept = first_n(best, ["question_id"], [F.col("place"), F.col("vec_id")], n + 2)
    return kept.select("question_id", "vec_id", F.col("place.variant").alias("variant"), F.col("place.rank").alias("rank"), "distance")


def expand_neighbors(hits: DataFrame, edges: DataFrame, query: str = "query_id", node: str = "node") -> DataFrame:
    """Partners one edge away from the hits that are not hits themselves, each once per query."""
    seen = hits.select(query, node).distinct()
    reached = seen.join(edges, seen[node] == edges["src"]).select(query, F.col("dst").alias(node)).distinct()
    return reached.join(seen, [query, node], "left_anti")
