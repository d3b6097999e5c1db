"""Hard negatives for anchor vectors, scored exactly by table lookups in the manner of the Four Russians.

Vectors become whole numbers. The components of an anchor are taken in groups of eight, and the sum of every subset of a group is
put into a table of 256 entries. A candidate is packed into bit planes (two's complement), so the byte of a plane and a group picks
the sum of the anchor's components at which the candidate has that bit; the planes are shifted and added, the top one negative.

Anchors and candidates are dealt into blocks of bounded size; every pair of an anchor block and a candidate block is a task of its
own, which returns a few rows for each anchor. Positives are found by one such pass, the negatives between their bounds by a second.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import stored, table

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 80, 100
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
#: Rows of a block of anchors and of a block of candidates, and anchors whose tables are held at once.
ANCHORS, CANDIDATES, TABLES = 1024, 4096, 128
_FEW = np.iinfo(np.int64).min

POSITIVE_SCHEMA = "key long, anchor_id long, id long, score long"
NEGATIVE_SCHEMA = "key long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(vectors), width), np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = vectors.flatten().to_numpy(zero_copy_only=False)
    return out


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Bytes ``[plane, row, group]`` of the two's complement; as many planes as the largest value needs."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    planes = max(high.bit_length(), (-low - 1).bit_length() if low < 0 else 0) + 1
    return np.stack([np.packbits(((values >> p) & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(planes)])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums ``[group, subset, anchor]`` of the components that each subset of a group of eight holds."""
    groups = anchors.reshape(len(anchors), -1, 8).transpose(1, 2, 0)
    sums = np.zeros((len(groups), 256, len(anchors)), anchors.dtype)
    for j in range(8):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + groups[:, j : j + 1]
    return sums


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products ``[candidate, anchor]``: one lookup for each plane and group, planes shifted and added from the top."""
    total = np.zeros((planes.shape[1], sums.shape[2]), sums.dtype)
    for at, plane in enumerate(planes[::-1]):
        total <<= 1
        for group, subsets in zip(plane.T, sums):
            found = subsets.take(group, axis=0)
            total = total - found if at == 0 else np.add(total, found, out=total)
    return total


def block_scores(candidates: np.ndarray, anchors: np.ndarray):
    """``(first anchor, scores [anchor, candidate])`` for a few anchors at a time, in 64-bit whole numbers."""
    planes = bit_planes(candidates)
    bound = candidates.shape[1] * max(1, int(abs(anchors).max(initial=0))) << len(planes)
    kind = np.int32 if bound < 1 << 30 else np.int64
    for at in range(0, len(anchors), TABLES):
        yield at, scores(planes, subset_sums(anchors[at : at + TABLES].astype(kind))).T.astype(np.int64)


def ranked(score: np.ndarray, usable: np.ndarray) -> np.ndarray:
    """Usable candidates from the highest score down, ties by place."""
    found = np.flatnonzero(usable)
    return found[np.argsort(-score[found], kind="stable")]


def _sides(candidates: pa.Table, anchors: pa.Table):
    candidates, anchors = candidates.sort_by("id").combine_chunks(), anchors.combine_chunks()
    columns = [t.column("v").combine_chunks() for t in (candidates, anchors)]
    width = -8 * (-max([1, *(int(c.value_lengths().to_numpy(zero_copy_only=False).max(initial=0)) for c in columns)]) // 8)
    return candidates, anchors, matrix(columns[0], width), matrix(columns[1], width)


def _positives(count: int):
    names = ["key", "anchor_id", "id", "score"]
    empty = pa.schema([(n, pa.int64()) for n in names]).empty_table()

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not candidates.num_rows or not anchors.num_rows:  # such a side comes without columns
            return empty
        candidates, anchors, left, right = _sides(candidates, anchors)
        ids, labels = candidates["id"].to_numpy(), candidates["label"].to_numpy()
        keys, own, label = (anchors[n].to_numpy() for n in ("key", "id", "label"))
        out = [np.empty((4, 0), np.int64)]
        for at, found in block_scores(left, right):
            for k, score in enumerate(found, at):
                usable = (labels == label[k]) & (ids != own[k])
                if usable.sum() > count:
                    kept = np.where(usable, score, _FEW)
                    usable &= score >= np.partition(kept, -count)[-count]
                best = ranked(score, usable)[:count]
                out.append(np.stack([np.full(len(best), keys[k]), np.full(len(best), own[k]), ids[best], score[best]]))
        return pa.table([pa.array(c) for c in np.concatenate(out, axis=1)], names=names)

    return run


def _negatives(count: int, low: int, high: int):
    names = ["key", "anchor_id", "place", "positive_id", "positive_score", "id", "score"]
    empty = pa.schema([(n, pa.int32() if n == "place" else pa.int64()) for n in names]).empty_table()

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not candidates.num_rows or not anchors.num_rows:  # such a side comes without columns
            return empty
        candidates, anchors, left, right = _sides(candidates, anchors)
        ids, labels = candidates["id"].to_numpy(), candidates["label"].to_numpy()
        keys, own, label = (anchors[n].to_numpy() for n in ("key", "id", "label"))
        positives = anchors["positives"].to_pylist()
        out = [np.empty((7, 0), np.int64)]
        for at, found in block_scores(left, right):
            for k, score in enumerate(found, at):
                other = labels != label[k]
                for p in positives[k]:
                    usable = other & (100 * score >= low * p["score"]) & (100 * score <= high * p["score"])
                    best = ranked(score, usable)[:count]
                    fixed = [np.full(len(best), x) for x in (keys[k], own[k], p["place"], p["id"], p["score"])]
                    out.append(np.stack([*fixed, ids[best], score[best]]))
        columns = [pa.array(c) for c in np.concatenate(out, axis=1)]
        columns[2] = columns[2].cast(pa.int32())
        return pa.table(columns, names=names)

    return run


def _in_blocks(candidates: DataFrame, anchors: DataFrame, blocks: tuple[int, int], function, schema: str) -> DataFrame:
    """Apply ``function`` to every pair of a block of candidates and a block of anchors."""
    of_anchors, of_candidates = blocks
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = candidates.withColumn("c", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(of_candidates)).cast("int")).withColumn("a", every(of_anchors))
    right = anchors.withColumn("a", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(of_anchors)).cast("int")).withColumn("c", every(of_candidates))
    right = right.select(*[F.col(name).alias(name) for name in right.columns])  # both sides come from one table: columns of its own
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(function, schema)


def best_rows(rows: DataFrame, by: list[str], count: int) -> DataFrame:
    """The first ``count`` rows of each group by score, ties by id, and their place from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "id")
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)


def hard_negatives(
    vectors: DataFrame, anchor: Column, vec_id: str = "vec_id", label: str | Column = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``; ``anchor`` says which rows are anchors.

    Components become ``floor(scale * x)``; scores are integer inner products in 64 bits; a shorter vector counts as filled up with
    zeros. An anchor's positives are its first ``positives`` other rows of the same label; for each of them, the first ``negatives``
    rows of another label whose score is between ``low`` and ``high`` hundredths of the positive's. Higher scores come first, ties
    by smaller id. Ids and labels are whole numbers. Rows with a null id, label or vector, or a component that is null or not finite, take no part. Rows
    of the anchor's own id are never its positives; a repeated row is a row among positives and negatives, a repeated anchor
    counts once. Anchors without positives, and an empty table, give no rows. Other columns are not read.
    """
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False)))
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    chosen = vectors.select(
        F.col(vec_id).cast("long").alias("id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        whole.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor"), finite.alias("finite"),
    )
    rows = stored(chosen.filter("id is not null and label is not null and v is not null and finite").drop("finite"), "vectors")
    candidates = rows.select("id", "label", "v")
    anchors = rows.filter("anchor").select(F.xxhash64("id", "label", "v").alias("key"), "id", "label", "v").dropDuplicates(["key"])
    n, m = rows.agg(F.count("*"), F.count_if("anchor")).first()
    blocks = max(1, math.ceil(m / ANCHORS)), max(1, math.ceil(n / CANDIDATES))
    near = best_rows(_in_blocks(candidates, anchors, blocks, _positives(positives), POSITIVE_SCHEMA), ["key"], positives)
    lists = near.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.col("rank").alias("place"), "id", "score"))).alias("positives"))
    with_positives = anchors.join(stored(lists, "positives"), "key")
    found = _in_blocks(candidates, with_positives, blocks, _negatives(negatives, low, high), NEGATIVE_SCHEMA)
    best = best_rows(found, ["key", "place"], negatives)
    return best.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % ANCHOR_EVERY == 0, label=label)


ORACLE = """
with whole as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), pairs as (
  select a.vec_id as anchor_id, c.vec_id as id, a.label = c.label as same, list_inner_product(a.v, c.v)::bigint as score
  from whole a join whole c on a.vec_id % 100 = 0
), positives as (
  select anchor_id, id as positive_id, score as positive_score from pairs where same and id <> anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
), found as (
  select p.anchor_id, p.positive_id, c.id as negative_id, p.positive_score, c.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by c.score desc, c.id) as rank
  from positives p join pairs c on c.anchor_id = p.anchor_id and not c.same
    and 80 * p.positive_score <= 100 * c.score and 100 * c.score <= 100 * p.positive_score
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from found where rank <= 5
"""
