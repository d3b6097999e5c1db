"""Mixing sources to target weights through soft membership.

A classifier fitted on the labelled table gives every document posteriors over the domains. Document rates, how often a document
is to be used, then solve a nonnegative least-squares problem: the expected tokens of each domain, summed over documents by
posterior, come as close as possible to the domain's share of the token budget, and among such rates those near 1 are taken:

    minimise  1/2 sum_k (sum_i w_i p_ik r_i - t_k)^2 + ridge/2 sum_i w_i (r_i - 1)^2   over  r_i >= 0,   w_i = tokens_i / tokens

Accelerated projected gradient needs one number per domain from each pass over the data. A rate depends on the posteriors and on
these numbers only, so no rates are kept between passes: a pass folds the history of numbers over the posteriors. Posteriors have
three decimals, and documents with equal ones are summed up before the passes. Everything is column expressions.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import free_name, stored, table

#: Fixed value: the mixture that the registered query and the pipeline aim at, by language.
TARGETS = {"de": 0.2, "en": 0.4, "es": 0.15, "fr": 0.25}
#: Labelled rows the classifier is fitted on at most, those whose id hashes lowest; word buckets; smoothing.
MAX_LABELLED = 20_000
BUCKETS = 4096
SMOOTH = 0.1
DECIMALS = 3
RIDGE = 1e-4
STEPS = 100
CLOSE = 1e-6


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def classifier(docs: DataFrame, labelled: DataFrame, domains: list[str], doc_id: str = "doc_id", text: str = "text", rows: int = MAX_LABELLED) -> tuple[DataFrame, list[float], list[float]]:
    """Naive Bayes over word buckets: ``(bucket, l0, l1, ...)`` with log-probabilities by domain, those of an unseen bucket, log priors.

    ``labelled``: ``(doc_id, domain)``; rows of other domains are not used. The chosen rows are few by ``rows`` and the buckets by
    ``BUCKETS``, so both are sent to every task.
    """
    chosen = labelled.filter(F.col("domain").isin(domains) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), "domain")
    chosen = stored(chosen.orderBy(F.xxhash64("id"), "id", "domain").limit(rows), "labelled")
    seen = docs.select(F.col(doc_id).alias("id"), F.array_distinct(words(F.col(text))).alias("w")).join(F.broadcast(chosen), "id")
    each = seen.select("domain", F.explode("w").alias("word")).select("domain", _bucket(F.col("word")).alias("bucket"))
    counts = stored(each.groupBy("bucket").agg(*[F.count(F.when(F.col("domain") == d, 1)).alias(f"c{k}") for k, d in enumerate(domains)]), "buckets")
    totals = counts.agg(*[F.coalesce(F.sum(f"c{k}"), F.lit(0)) for k in range(len(domains))]).first()
    rest = [t + SMOOTH * BUCKETS for t in totals]
    table_ = counts.select("bucket", *[F.log((F.col(f"c{k}") + SMOOTH) / rest[k]).alias(f"l{k}") for k in range(len(domains))])
    shares = dict(chosen.groupBy("domain").count().collect())
    priors = [math.log((shares.get(d, 0) + 1) / (sum(shares.values()) + len(domains))) for d in domains]
    return table_, [math.log(SMOOTH / r) for r in rest], priors


def posteriors(docs: DataFrame, row: str, model: tuple[DataFrame, list[float], list[float]], text: str = "text") -> DataFrame:
    """``(row, n_tokens, p0, p1, ...)``; the log-likelihood is divided by the root of the number of words, as words of a text
    depend on each other. Texts without words get the priors.
    """
    weights, unseen, priors = model
    k = range(len(priors))
    each = docs.select(F.col(row).alias("row"), F.explode_outer(words(F.col(text))).alias("word")).select("row", _bucket(F.col("word")).alias("bucket"), F.col("word").isNotNull().cast("long").alias("is_word"))
    joined = each.join(F.broadcast(weights), "bucket", "left")
    value = lambda i: F.when(F.col("is_word") == 1, F.coalesce(F.col(f"l{i}"), F.lit(unseen[i]))).otherwise(0.0)
    summed = joined.groupBy("row").agg(F.sum("is_word").alias("n_tokens"), *[F.sum(value(i)).alias(f"s{i}") for i in k])
    logit = summed.select("row", "n_tokens", *[(F.lit(priors[i]) + F.col(f"s{i}") / F.sqrt(F.greatest(F.lit(1), "n_tokens"))).alias(f"s{i}") for i in k])
    top = F.greatest(*[F.col(f"s{i}") for i in k]) if len(priors) > 1 else F.col("s0")
    raised = logit.select("row", "n_tokens", *[F.exp(F.col(f"s{i}") - top).alias(f"e{i}") for i in k])
    whole = sum((F.col(f"e{i}") for i in k), F.lit(0.0))
    return raised.select("row", "n_tokens", *[F.round(F.col(f"e{i}") / whole, DECIMALS).alias(f"p{i}") for i in k])


def _folded(history: list[tuple[list[float], float]], step: float, k: int) -> Column:
    """The point that the next pass evaluates, from the posteriors and the numbers of all passes before.

    ``history``: residuals of each pass and the weight with which the point is moved on after it.
    """
    if not history:
        return F.lit(1.0)
    passes = ", ".join(f"array({', '.join(f'{v!r}D' for v in (*residual, on))})" for residual, on in history)
    slope = " + ".join(f"p{i} * x[{i}]" for i in range(k))
    rate = f"greatest(0D, s.y - {step!r}D * ({slope} + {RIDGE!r}D * (s.y - 1D)))"
    moved = f"named_struct('r', {rate}, 'y', {rate} + x[{k}] * ({rate} - s.r))"
    return F.expr(f"aggregate(array({passes}), named_struct('r', 1D, 'y', 1D), (s, x) -> {moved}, s -> s.y)")


def fit_rates(found: DataFrame, targets: list[float], steps: int = STEPS) -> tuple[Column, list[float]]:
    """The rate as an expression over ``p0, p1, ...`` and the shares of the token budget it reaches.

    Momentum starts anew whenever the residuals grow. Ends when the reached shares stay the same for three passes, or after
    ``steps``; the last pass moves on without momentum, so that the rate is the projected one. Without tokens every rate is 1.
    """
    k = len(targets)
    names = [f"p{i}" for i in range(k)]
    groups = stored(found.groupBy(*names).agg(F.sum("n_tokens").cast("double").alias("n")), "posterior_groups")
    tokens = groups.agg(F.sum("n")).first()[0]
    if not tokens:
        return F.lit(1.0), [0.0] * k
    weight = F.col("n") / tokens
    gram = groups.agg(*[F.sum(weight * F.col(a) * F.col(b)) for a in names for b in names]).first()
    step, history, calm, before = 1 / (float(np.linalg.eigvalsh(np.array(gram).reshape(k, k)).max()) + RIDGE), [], 0, None
    inertia, worst = 1.0, math.inf
    while True:
        point = _folded(history, step, k)
        shares = list(groups.select(point.alias("y"), "n", *names).agg(*[F.sum(weight * F.col(p) * F.col("y")) for p in names]).first())
        calm = calm + 1 if before and max(abs(a - b) for a, b in zip(shares, before)) < CLOSE else 0
        before, residual = shares, [a - b for a, b in zip(shares, targets)]
        norm = math.hypot(*residual)
        inertia, worst = (1.0 if norm > worst else inertia), norm
        after = (1 + math.sqrt(1 + 4 * inertia * inertia)) / 2
        last = calm >= 3 or len(history) >= steps
        history.append((residual, 0.0 if last else (inertia - 1) / after))
        inertia = after
        if last:
            return _folded(history, step, k), shares


def _checked(targets: dict[str, float]) -> tuple[list[str], list[float]]:
    if not targets or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("targets are nonnegative weights, not all zero")
    domains = sorted(targets)
    return domains, [targets[d] / sum(targets.values()) for d in domains]


def document_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens``, ``p_<domain>`` for each domain, ``rate``.

    Null and empty texts have no tokens and the priors as posteriors. Without labelled rows all posteriors are equal. Repeated
    rows each give a row and count.
    """
    domains, shares = _checked(targets)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = posteriors(narrow.withColumn("row", F.struct(F.monotonically_increasing_id().alias("at"), "doc_id")), "row", classifier(narrow, labelled, domains), "text")
    found = stored(found, "posteriors")
    rate, _ = fit_rates(found, shares)
    return found.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", *[F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)], rate.alias("rate"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The mixture itself: each document as often as its rate says, with the columns ``rate`` and ``copy`` (from 1) added.

    The fraction of a rate is met by a hash of id and text, so that the expected tokens are those of the rates. Names that the
    table has already get an underscore in front.
    """
    domains, shares = _checked(targets)
    row, rate, copy = (free_name(docs, x) for x in ("row", "rate", "copy"))
    marked = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mixing")
    found = stored(posteriors(marked, row, classifier(marked, labelled, domains, doc_id, text), text), "posteriors")
    fitted, _ = fit_rates(found, shares)
    rates = found.select(F.col("row").alias(row), fitted.alias(rate))
    chance = F.pmod(F.xxhash64(F.lit("mixing"), doc_id, text), F.lit(1 << 30)) / float(1 << 30)
    times = (F.floor(F.col(rate)) + (chance < F.col(rate) - F.floor(F.col(rate))).cast("int")).cast("int")
    # Rates grow with the corpus: they are dealt out with the texts at every size, without sorting the texts.
    joined = marked.join(rates.hint("shuffle_hash"), row).withColumn(copy, times).filter(F.col(copy) > 0)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copy)))).select(*docs.columns, rate, copy)


def labelled_languages(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", domain: str = "lang") -> DataFrame:
    """``(doc_id, domain)`` of the documents that the labelled table covers."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(domain).alias("domain")).join(labels.select("doc_id").distinct(), "doc_id", "left_semi")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return document_rates(docs, labelled_languages(docs, table(spark, sf_dir, "labels")), TARGETS)
