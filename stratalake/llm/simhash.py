"""SimHash near-dedup through a Gray-order hierarchical index.

Fingerprints are cut into six blocks of bits. Two of them that differ in at most four bits agree in at least two blocks, so
each distinct fingerprint goes once to each of the fifteen tables of two blocks, keyed by the bits of these blocks. The members
of a key are sorted by Gray rank, neighbours in that order share long bit patterns, and these patterns are factored into upper
nodes: a node holds the bits all fingerprints below it share and its parent does not. A query goes down from the root, adds up
the differing bits of each node, and leaves a whole group as soon as the sum exceeds the distance. Groups that belong to the
query's component already are left as well: only links that join components matter.

A key with more members than ``cell`` is cut into blocks, and every pair of blocks is searched by a task of its own.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.components import connected_components
from stratalake.llm.tables import free_name, stored, table

SHINGLE = 4
DISTANCE = 4
SEED = 42
FANOUT = 8
CELL = 16_384
#: Widths of the six blocks.
WIDTHS = (11, 11, 11, 11, 10, 10)
#: Query-candidate pairs that may be held at once, and shingles hashed at once.
PAIRS = 1 << 20
HASHES = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit fingerprint of a whole text; zero without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros((8, 8), np.int64)
    for at in range(0, len(starts), HASHES):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at : at + HASHES], ends[at : at + HASHES])]
        lanes = np.array(part, "<u8").view(np.uint8).reshape(-1, 8) + _LANES
        ones += np.bincount(lanes.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    return int.from_bytes(np.packbits((2 * ones > len(starts)).astype(np.uint8), axis=1, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, name: str, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """All columns and the fingerprint as a signed long. A null text counts as empty."""
    place = docs.columns.index(text)
    schema = docs.select("*", F.lit(0).cast("long").alias(name)).schema

    def run(batches):
        for batch in batches:
            found = np.array([simhash(t.as_py(), shingle) for t in batch.column(place)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of each value in Gray order: the number whose Gray code the value is."""
    out = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


def _first(groups: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))


class GrayIndex:
    """Hierarchical index over several groups of fingerprints; rows must be in order of group, then Gray rank."""

    def __init__(self, groups: np.ndarray, values: np.ndarray, fanout: int = FANOUT):
        self.values, self.groups = values, groups
        #: From the leaves up: first child, number of children, shared bits, their values, last leaf below, group.
        levels = [(None, None, np.full(len(values), ~np.uint64(0)), values, np.arange(len(values)), groups)]
        every, some = values, values
        while len(levels[-1][5]) != len(first := _first(levels[-1][5])):
            group = levels[-1][5]
            place = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
            starts = np.flatnonzero(place % fanout == 0)
            every, some = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)
            counts = np.diff(np.append(starts, len(group)))
            levels.append((starts, counts, ~(every ^ some), every, levels[-1][4][starts + counts - 1], group[starts]))
        self.levels = levels
        #: Bits of each node that its parent does not have.
        self.own = [levels[-1][2]] * len(levels)
        for k in range(len(levels) - 1, 0, -1):
            self.own[k - 1] = levels[k - 1][2] & ~np.repeat(levels[k][2], levels[k][1])

    def link(self, distance: int = DISTANCE) -> np.ndarray:
        """For each row the first row of its component, among the links within its own group."""
        label = np.arange(len(self.values))
        root = np.searchsorted(_first(self.groups), label, "right") - 1
        sizes = np.bincount(root)
        weight = np.cumsum(sizes[root])
        cuts = [0, *np.searchsorted(weight, np.arange(PAIRS, weight[-1], PAIRS), "right").tolist(), len(label)]
        for a, b in zip(cuts, cuts[1:]):
            if a < b:
                self._search(np.arange(a, b), root, label, distance)
        return label

    def _search(self, query: np.ndarray, root: np.ndarray, label: np.ndarray, distance: int) -> None:
        lows, highs = [label], [label]
        for starts, *_ in self.levels[1:]:
            lows.append(np.minimum.reduceat(lows[-1], starts))
            highs.append(np.maximum.reduceat(highs[-1], starts))
        node, differing = root[query], np.zeros(len(query), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            _, _, _, pattern, last, _ = self.levels[k]
            differing = differing + np.bitwise_count((self.values[query] ^ pattern[node]) & self.own[k][node])
            known = (lows[k][node] == label[query]) & (highs[k][node] == label[query])
            stay = (differing <= distance) & (last[node] > query) & ~known
            query, node, differing = query[stay], node[stay], differing[stay]
            if k:
                starts, counts = self.levels[k][:2]
                many = counts[node]
                inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                query, differing = np.repeat(query, many), np.repeat(differing, many)
                node = np.repeat(starts[node], many) + inside
        _unite(label, query, node)


def _unite(label: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Join the components of each pair; a label is the smallest row of its component."""
    while len(left):
        a, b = label[left], label[right]
        open_ = a != b
        left, right = left[open_], right[open_]
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while (label[label] != label).any():
            label[:] = label[label]


def _masks() -> list[int]:
    blocks, low = [], 0
    for width in WIDTHS:
        blocks.append(((1 << width) - 1) << low)
        low += width
    masks = [a | b for i, a in enumerate(blocks) for b in blocks[i + 1 :]]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _link_partition(batches):
    """Links of the groups of one partition, whose rows come in order of group. Groups are never cut by a batch."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def links(group, value):
        if len(value) == 0:
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, schema=schema)
        fast = value.view(np.uint64)
        order = np.lexsort((gray_rank(fast), group))
        group, fast = group[order], fast[order]
        label = GrayIndex(group, fast).link()
        far = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(fast[far].view(np.int64)), pa.array(fast[label[far]].view(np.int64))], schema=schema)

    held: list[tuple[np.ndarray, ...]] = []
    number, last = 0, None
    for batch in batches:
        *keys, value = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns))
        if not len(value):
            continue
        new = reduce(np.logical_or, (k[1:] != k[:-1] for k in keys)) if len(value) > 1 else np.zeros(0, bool)
        group = np.cumsum(np.concatenate(([last is not None and last != [k[0] for k in keys]], new))) + number
        number, last = int(group[-1]), [k[-1] for k in keys]
        held.append((group, value))
        if sum(len(v) for _, v in held) >= 1 << 16:
            groups, values = (np.concatenate(x) for x in zip(*held))
            whole = groups < number
            yield links(groups[whole], values[whole])
            held = [(groups[~whole], values[~whole])]
    if held:
        yield links(*(np.concatenate(x) for x in zip(*held)))


def fingerprint_links(distinct: DataFrame, cell: int = CELL) -> DataFrame:
    """Links ``(u, v)`` that connect the same fingerprints as all pairs within the distance do. ``distinct``: column ``f``."""
    spark = distinct.sparkSession
    keyed = distinct.select("f", F.posexplode(F.array(*[F.col("f").bitwiseAND(F.lit(m)) for m in _masks()])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").count().filter("count > 1")
    cut = keyed.join(sizes, ["t", "key"]).withColumn("cuts", F.ceil(F.col("count") / cell).cast("int"))
    mine = F.pmod(F.xxhash64("f"), F.col("cuts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    cells = cut.withColumn("mine", mine).select("t", "key", "f", "mine", other)
    cells = cells.select("t", "key", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "f")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = cells.repartition(n, "t", "key", "lo", "hi").sortWithinPartitions("t", "key", "lo", "hi")
    return dealt.mapInArrow(_link_partition, "u long, v long")


def fingerprint_components(marked: DataFrame, name: str, doc_id: str = "doc_id") -> DataFrame:
    """``(f, root, component_id)`` for every distinct fingerprint in column ``name``: the smallest id that links reach."""
    distinct = stored(marked.groupBy(F.col(name).alias("f")).agg(F.min(doc_id).alias("first_id")), "fingerprints")
    roots = connected_components(fingerprint_links(distinct))
    members = roots.select(F.col("u").alias("f"), "root").union(roots.select(F.col("root").alias("f"), "root").distinct())
    smallest = members.join(distinct, "f").groupBy("root").agg(F.min("first_id").alias("component_id"))
    joined = members.join(smallest, "root")
    return distinct.join(joined, "f", "left").select("f", F.coalesce("root", "f").alias("root"), F.coalesce("component_id", "first_id").alias("component_id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id``.

    Null texts count as empty; texts without words have fingerprint zero and are linked like any other. Repeated rows each
    give a row. Rows without an id are linked too; a component without any id has a null ``component_id``. Other columns are
    not read. An empty table gives no rows.
    """
    marked = stored(with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "f").select("doc_id", "f"), "simhash")
    found = fingerprint_components(marked, "f")
    return marked.join(found, "f").select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of one document of each component: the one with the smallest id.

    Of several rows with that id the one whose text hashes lowest stays, of identical rows any one. Ids are compared with
    nulls equal, so a component without ids keeps one row too. An empty table stays empty.
    """
    f, row = free_name(docs, "fingerprint"), free_name(docs, "row")
    marked = stored(with_fingerprint(docs, f, text).withColumn(row, F.monotonically_increasing_id()), "simhash")
    narrow = marked.select(F.col(f).alias("f"), F.col(doc_id).alias("id"), F.struct(F.xxhash64(text), F.col(row).alias("row")).alias("place"))
    found = narrow.join(fingerprint_components(marked, f, doc_id), "f").filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = found.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place.row").alias(row))
    return marked.join(chosen, row, "left_semi").select(*docs.columns)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
