"""Quality classifier: a generalised additive model with pairwise interactions.

Every feature has a lookup table over bins, and a few pairs of features have a table over pairs of coarse bins. Boosting goes
round the features in a fixed cycle; each step adds a shallow tree over one table to that table, so the fitted model is the sum
of tables and a document is scored by adding up its bins' entries. The tables are fitted on a bounded sample of labelled rows,
of which only the features reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.labelled import MAX_LABELLED, held_out, labelled_sample
from stratalake.llm.tables import free_name, table

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
BINS, COARSE, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE, SPLITS, RIDGE, LEAST = 120, 60, 0.1, 3, 5.0, 20
FEATURES = (
    "chars", "words", "mean_word", "longest_word", "upper", "symbols", "digits", "stops", "lines", "distinct_words", "repeated_words",
    "distinct_lines", "accents", "short_words", "bare_symbols", "commas",
)
_KIND = np.zeros((7, 256))
_KIND[0, 65:91] = 1
_KIND[1, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"-"]] = 1
_KIND[2, 48:58] = 1
_KIND[3, ord(".")] = 1
_KIND[4, ord(",")] = 1
_KIND[5, 128:] = 1
_KIND[6, 97:123] = 1


def features(text: str | None) -> np.ndarray:
    """Numbers about a whole text; all zero for an empty one."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(len(FEATURES))
    upper, symbols, digits, stops, commas, accents, small = _KIND @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = raw.split(b"\n")
    n, size = len(words), len(raw)
    again = sum(a == b for a, b in zip(words, words[1:]))
    bare = sum(map(words.count, (b"|", b"-", b"*", b"#"))) / n
    return np.array([
        math.log1p(size), math.log1p(n), lengths.mean(), math.log1p(lengths.max()), upper / max(1.0, upper + small), symbols / size, digits / size, stops / n,
        len(lines) / n, len(set(words)) / n, again / n, len(set(lines)) / len(lines), accents / size, (lengths <= 3).mean(), bare, commas / n,
    ])


def _tree(gradient: np.ndarray, weight: np.ndarray, count: np.ndarray, splits: int = SPLITS) -> np.ndarray:
    """Newton step of a tree with a few splits over the bins of one feature, grown by gain; bins are in order."""
    g, h, c = (np.concatenate(([0.0], np.cumsum(x))) for x in (gradient, weight, count))
    cuts, leaves = [], [(0, len(gradient))]
    gain = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)
    for _ in range(splits):
        best = (1e-9, None, None)
        for a, b in leaves:
            k = np.arange(a + 1, b)
            k = k[(c[k] - c[a] >= LEAST) & (c[b] - c[k] >= LEAST)]
            if len(k):
                gains = gain(a, k) + gain(k, b) - gain(a, b)
                best = max(best, (gains.max(), int(k[gains.argmax()]), (a, b)), key=lambda x: x[0])
        if best[1] is None:
            break
        leaves.remove(best[2])
        leaves += [(best[2][0], best[1]), (best[1], best[2][1])]
        cuts.append(best[1])
    out = np.zeros(len(gradient))
    for a, b in leaves:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return out


@dataclass
class AdditiveModel:
    """Tables by feature and by pair of features; ``edges`` are the borders of the bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1)

    def coarse(self, bins: np.ndarray) -> np.ndarray:
        return np.stack([bins[:, j] * COARSE // (len(e) + 1) for j, e in enumerate(self.edges)], axis=1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if len(x) and self.tables:
            bins = self.bins(x)
            coarse = self.coarse(bins)
            for j, entries in enumerate(self.tables):
                total += entries[bins[:, j]]
            for (i, j), entries in self.pairs.items():
                total += entries[coarse[:, i], coarse[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting. Without rows of both classes the model is the smoothed share of ones."""
    ones = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(base=math.log(ones / (1 - ones)))
    if len(set(y.tolist())) < 2:
        return model
    model.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = model.bins(x)
    coarse = model.coarse(bins)
    total = np.full(len(y), model.base)

    def step(place: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
        p = 1 / (1 + np.exp(-total))
        return np.bincount(place, y - p, size), np.bincount(place, p * (1 - p), size), np.bincount(place, minlength=size)

    for _ in range(ROUNDS):
        for j, entries in enumerate(model.tables):
            more = RATE * _tree(*step(bins[:, j], len(entries)))
            entries += more
            total += more[bins[:, j]]
    cell = {(i, j): coarse[:, i] * COARSE + coarse[:, j] for i, j in combinations(range(x.shape[1]), 2)}

    def cross(i: int, j: int) -> np.ndarray:
        """A tree that cuts one feature once and the other on either side."""
        g, h, c = (a.reshape(COARSE, COARSE) for a in step(cell[i, j], COARSE * COARSE))
        best, out = 0.0, np.zeros((COARSE, COARSE))
        for turned in (False, True):
            gt, ht, ct = (a.T if turned else a for a in (g, h, c))
            for k in range(1, COARSE):
                made = np.zeros((COARSE, COARSE))
                for part in (slice(0, k), slice(k, COARSE)):
                    made[part] = _tree(gt[part].sum(0), ht[part].sum(0), ct[part].sum(0), 1)
                gain = (2 * made * gt - made**2 * (ht + RIDGE / COARSE)).sum()
                if gain > best:
                    best, out = gain, made.T if turned else made
        return out

    gains = {k: (lambda m, g: (m * g).sum())(cross(*k), step(cell[k], COARSE * COARSE)[0].reshape(COARSE, COARSE)) for k in cell}
    for k in sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]:
        model.pairs[k] = np.zeros((COARSE, COARSE))
    for _ in range(PAIR_ROUNDS):
        for k, entries in model.pairs.items():
            more = RATE * cross(*k)
            entries += more
            total += more.ravel()[cell[k]]
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = MAX_LABELLED) -> AdditiveModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold."""
    sample = labelled_sample(docs, labels, "quality", FOLDS, HELD_OUT, doc_id, text, rows)
    schema = pa.schema([("key", pa.int64()), ("label", pa.int32()), ("x", pa.list_(pa.float64()))])

    def run(batches):
        for batch in batches:
            found = [features(t.as_py()).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, schema.field("x").type)], schema=schema)

    # Ids may repeat in the documents: the bound holds for the rows that reach the driver too.
    seen = sample.mapInArrow(run, "key long, label int, x array<double>").orderBy(F.xxhash64("key"), "key", "label", "x").limit(rows).toPandas()
    x = np.array(seen["x"].tolist(), float).reshape(-1, len(FEATURES))
    return fit(x, seen["label"].to_numpy(float))


def with_score(docs: DataFrame, model: AdditiveModel, name: str, text: str = "text") -> DataFrame:
    """All columns and the score; a null text counts as empty."""
    place, schema = docs.columns.index(text), docs.select("*", F.lit(0.0).alias(name)).schema

    def run(batches):
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(place)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts get the score of all-zero features. Without labels every score is one half. Repeated rows each give a
    row; other columns are not read.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = with_score(narrow, train(docs, labels, doc_id, text), "score")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that the classifier does not reject, all columns as they are."""
    name = free_name(docs, "quality_score")
    return with_score(docs, train(docs, labels, doc_id, text), name, text).filter(F.col(name) >= THRESHOLD).select(*docs.columns)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
