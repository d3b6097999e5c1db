"""Toxicity: significant high-scoring passages of token log-odds.

The log-odds of a token between toxic and clean labelled documents use an informative Dirichlet prior, the sample's own token
frequencies with the weight of the smaller class, and are lowered by a multiple of their standard error, so that rare tokens say
little. Less a drift they are the scores of a walk that falls on ordinary text, and a linear-time scan finds all maximal-scoring
passages. Extreme-value theory tells how often ordinary text of the document's length has a passage of such a score
(``E = K n exp(-lambda S)``), and how likely it has several passages whose scores add up to such a sum; the least likely number of
passages is the document's evidence, which does not grow with its length alone. It is calibrated to a probability.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.labelled import MAX_LABELLED, held_out, labelled_sample
from stratalake.llm.tables import free_name, table

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Standard errors taken off (there are very many tokens), fall of the walk per token.
ERRORS, DRIFT = 2.5, 0.4
#: Passages with fewer expected in ordinary text are significant.
EXPECTED = 0.5
EVIDENCE = 3
#: Evidence beyond this adds nothing.
FULL = 30.0
#: Shares of clean documents whose best passage the scale of the extreme-value law is read from; the most cautious one counts.
QUANTILES = (0.1, 0.25, 0.5)
#: Lengths of word beginnings that count as tokens of their own, for words that labelled documents do not hold.
BEGINNINGS = (5, 7)
#: Scores of tokens that a task keeps at hand.
CACHE = 500_000
_TOKEN = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _TOKEN.findall((text or "").lower())


def with_beginnings(word: str) -> list[str]:
    """The token and its beginnings, which are marked so that they differ from whole words."""
    return [word, *(f"^{word[:n]}" for n in BEGINNINGS if len(word) > n)]


class _Scores(dict):
    """Score of each token seen, the best of the token and its beginnings; None where the model has none of them."""

    def __init__(self, known: dict[str, float]):
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> float | None:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = max((self.known[x] for x in with_beginnings(word) if x in self.known), default=None)
        return found


def passages(places: list[int], scores: list[float], drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring passages ``(first, last, score)`` of a walk.

    The walk gains ``scores[k] - drift`` at ``places[k]`` and falls by ``drift`` at every other token. Each candidate keeps the
    sums before and after it; a new one is joined to the last candidate that starts lower and ends no higher. A candidate
    is joined or dropped once, so the scan is linear.
    """
    open_: list[list] = []  # first, last, sum before, sum after, index of the last candidate with a lower sum before
    total, last = 0.0, -1
    for at, score in zip(places, scores):
        total -= drift * (at - last - 1)
        last, before = at, total
        total += score - drift
        if total <= before:
            continue
        first, end, low, high = at, at, before, total
        k = len(open_) - 1
        while True:
            while k >= 0 and open_[k][2] >= low:
                k = open_[k][4]
            if k < 0 or open_[k][3] >= high:
                break
            first, low = open_[k][0], open_[k][2]
            del open_[k:]
            k -= 1
        open_.append([first, end, low, high, k])
    return [(a, b, high - low) for a, b, low, high, _ in open_]


def sum_evidence(normal: np.ndarray) -> float:
    """The largest ``-log P`` of ordinary text having ``r`` passages of such a sum of normalised scores, over all ``r``.

    ``P = exp(-T) T^(r-1) / (r! (r-1)!)`` for the sum ``T`` of the ``r`` best; trying several ``r`` costs a factor of two for each more.
    Only passages of a positive normalised score can help.
    """
    best = np.sort(normal[normal > 0])[::-1]
    if not len(best):
        return 0.0
    r, total = np.arange(1, len(best) + 1), np.cumsum(best)
    factorials = np.cumsum(np.log(r))
    before = np.concatenate(([0.0], factorials[:-1]))
    return float((total - (r - 1) * np.log(total) + factorials + before - r * math.log(2)).max())


@dataclass
class ToxicModel:
    scores: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # lambda of the extreme-value law
    scale: float = 0.1  # K
    weights: np.ndarray = field(default_factory=lambda: np.zeros(EVIDENCE + 1))

    def __post_init__(self):
        self.at_hand = _Scores(self.scores)

    def __getstate__(self):
        return (self.scores, self.rate, self.scale, self.weights)

    def __setstate__(self, state):
        self.scores, self.rate, self.scale, self.weights = state
        self.at_hand = _Scores(self.scores)

    def passages(self, words: list[str]) -> list[tuple[int, int, float]]:
        found = [(k, s) for k, s in enumerate(map(self.at_hand.__getitem__, words)) if s is not None]
        return passages([k for k, _ in found], [s for _, s in found], DRIFT) if found else []

    def evidence(self, words: list[str]) -> list[float]:
        """Evidence of the passages together, its logarithm, and the share of significant passages among the tokens."""
        n = len(words)
        found = self.passages(words)
        if not found:
            return [0.0] * EVIDENCE
        offset = -math.log(self.scale * n)
        together = min(FULL, max(0.0, sum_evidence(offset + self.rate * np.array([s for *_, s in found]))))
        covered = sum(b - a + 1 for a, b, s in found if offset + self.rate * s > -math.log(EXPECTED))
        return [together, math.log1p(together), covered / n]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + x.reshape(-1, EVIDENCE) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Newton steps of a logistic regression with a small penalty; the first weight is the constant."""
    a = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(a.shape[1])
    penalty = ridge * np.eye(len(w))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty, a.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fall_rate(gain: np.ndarray, share: np.ndarray) -> float:
    """The positive lambda at which the mean of ``exp(lambda * score)`` over ordinary tokens is one."""
    rest = max(0.0, 1 - share.sum())
    mean = lambda rate: (share * np.exp(rate * (gain - DRIFT))).sum() + rest * math.exp(-rate * DRIFT) - 1
    low, high = 0.0, 1e-3
    while mean(high) < 0 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 0 else (low, middle)
    return high


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = MAX_LABELLED) -> ToxicModel:
    """Fit on at most ``rows`` labelled documents outside the held-out fold; tokens are counted once per document."""
    sample = labelled_sample(docs, labels, "toxic", FOLDS, HELD_OUT, doc_id, text, rows)
    pair = pa.schema([("token", pa.string()), ("label", pa.int32())])

    def spread(batches):
        for batch in batches:
            for body, label in zip(batch.column(1), batch.column(2)):
                own = sorted({x for word in set(tokens(body.as_py())) for x in with_beginnings(word)})
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([label.as_py()] * len(own), pa.int32())], schema=pair)

    counts = sample.mapInArrow(spread, "token string, label int").groupBy("token").agg(
        F.sum("label").cast("double").alias("toxic"), F.sum(1 - F.col("label")).cast("double").alias("clean")
    )
    model = ToxicModel()
    total = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if total[0] and total[1]:
        n1, n0 = total
        weight = min(n1, n0)
        prior = weight * (F.col("toxic") + F.col("clean")) / (n1 + n0)
        odds = lambda y, n: F.log((y + prior) / (n + weight - y - prior))
        error = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
        scored = counts.withColumn("s", odds(F.col("toxic"), n1) - odds(F.col("clean"), n0) - ERRORS * error)
        kept = scored.filter(F.col("s") > 0).select("token", "s", ((F.col("clean") + 0.5) / (n0 + 1)).alias("share")).toPandas()
        model.scores.update(zip(kept["token"], kept["s"]))
        model.rate = _fall_rate(kept["s"].to_numpy(float), kept["share"].to_numpy(float))
    _calibrate(model, sample, rows)
    return model


def _of_sample(sample: DataFrame, rows: int, values, names: list[str]):
    """What ``values`` gives for the words of each text of the sample; its order does not depend on the partitions."""
    schema = pa.schema([("key", pa.int64()), ("label", pa.int32())] + [(n, pa.float64()) for n in names])

    def run(batches):
        for batch in batches:
            found = [values(tokens(body.as_py())) for body in batch.column(1)]
            columns = [pa.array([v[k] for v in found], pa.float64()) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], schema=schema)

    narrow = sample.select(F.xxhash64("id").alias("key"), "text", "label")
    found = narrow.mapInArrow(run, ", ".join(["key long, label int", *(f"{n} double" for n in names)]))
    return found.orderBy("key", "label", *names).limit(rows).toPandas()


def _calibrate(model: ToxicModel, sample: DataFrame, rows: int) -> None:
    """K from the best passages of clean documents, then the weights of the evidence."""
    best = lambda words: (len(words), max((s for *_, s in model.passages(words)), default=0.0))
    seen = _of_sample(sample, rows, best, ["n", "best"])
    y = seen["label"].to_numpy(float)
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        model.weights = np.array([math.log(share / (1 - share))] + [0.0] * EVIDENCE)
        return
    clean = seen[seen["label"] == 0]
    # n exp(-lambda best) of ordinary text falls below u with the probability 1 - exp(-K u).
    reached = np.quantile(clean["n"].clip(lower=1) * np.exp(-model.rate * clean["best"]), QUANTILES)
    model.scale = float(min(1.0, np.max(-np.log1p(-np.array(QUANTILES)) / np.maximum(reached, 1e-9))))
    names = [f"x{k}" for k in range(EVIDENCE)]
    x = _of_sample(sample, rows, model.evidence, names)
    model.weights = _logistic(x[names].to_numpy(), x["label"].to_numpy(float))


def with_score(docs: DataFrame, model: ToxicModel, name: str, text: str = "text") -> DataFrame:
    """All columns and the score; a null text counts as empty."""
    place, schema = docs.columns.index(text), docs.select("*", F.lit(0.0).alias(name)).schema

    def run(batches):
        for batch in batches:
            x = np.array([model.evidence(tokens(t.as_py())) for t in batch.column(place)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.score(x))], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def toxic_passages(docs: DataFrame, model: ToxicModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, first_token, last_token, score, expected`` for every significant passage."""
    schema = pa.schema([("doc_id", pa.int64()), ("first_token", pa.int64()), ("last_token", pa.int64()), ("score", pa.float64()), ("expected", pa.float64())])

    def run(batches):
        for batch in batches:
            out = []
            for key, body in zip(*batch.columns):
                words = tokens(body.as_py())
                for a, b, s in model.passages(words):
                    expected = model.scale * len(words) * math.exp(-model.rate * s)
                    if expected < EXPECTED:
                        out.append({"doc_id": key.as_py(), "first_token": a, "last_token": b, "score": s, "expected": expected})
            yield pa.RecordBatch.from_pylist(out, schema)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, first_token long, last_token long, score double, expected double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, score, predicted``.

    Null and empty texts have no passage and get the lowest score. Without labels every score is one half. Repeated rows each
    give a row; other columns are not read.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    scored = with_score(narrow, train(docs, labels, doc_id, text), free_name(narrow, "score"))
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
