import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import difference, duck
from stratalake.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score string, KEY int, rank int, id string"


def plain(rows, anchor, positives=5, negatives=5, low=80, high=100):
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], label))
    out, done = [], set()
    for i, v, label in kept:
        if not anchor(i) or (i, tuple(v), label) in done:
            continue
        done.add((i, tuple(v), label))
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other) for j, w, other in kept)
        own = [(-s, j) for s, j, other in scored if other == label and j != i][:positives]
        for s, j in own:
            found = [(-t, k) for t, k, other in scored if other != label and low * s <= -100 * t <= high * s][:negatives]
            out += [(i, j, rank, k, s, t) for rank, (t, k) in enumerate(found, 1)]
    return sorted(out)


def vectors(n, seed, width=11):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        centre = rng.choice([0.0, 0.3, -0.2, 0.3])
        v = [rng.choice([centre, centre + rng.gauss(0, 0.3), 1.0, -1.0]) for _ in range(width)]
        rows.append((i, v, rng.choice([0, 0, 0, 1, 2])))
    rows += [(i, rows[3][1], rows[3][2]) for i in range(n, n + 9)]  # the same vector many times: ties
    rows += [rows[5], rows[0]]
    rows += [(900, None, 1), (910, [1.0, None], 1), (920, [float("nan")] * 3, 1), (930, [float("inf")], 0), (940, [0.5], None), (None, [0.5], 1)]
    return rows + [(950, [], 1), (955, [0.7, 0.9], 0), (960, [300000.0] * 3, 2)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)


def test_lookups_are_inner_products():
    rng = np.random.default_rng(3)
    for low, high in [(-256, 256), (0, 3), (-1, 0), (0, 1), (-(10**9), 10**9)]:
        a, c = rng.integers(low, high, (5, 16)), rng.integers(low, high, (9, 16))
        found = np.concatenate([s for _, s in hn.block_scores(c, a)])
        assert (found == a @ c.T).all()


@pytest.mark.parametrize("blocks", [None, (7, 20, 3)])
def test_same_rows_as_brute_force(llm, monkeypatch, blocks):
    if blocks:
        for name, value in zip(("ANCHORS", "CANDIDATES", "TABLES"), blocks):
            monkeypatch.setattr(hn, name, value)
    rows = vectors(160, 4)
    found = hn.hard_negatives(frame(llm, rows), F.col("vec_id") % 5 == 0)
    expected = plain(rows, lambda i: i % 5 == 0)
    assert len(expected) > 200
    assert sorted(map(tuple, found.collect())) == expected


def test_other_counts_and_bounds(llm):
    rows = vectors(60, 9)
    found = hn.hard_negatives(frame(llm, rows), F.col("vec_id") < 10, positives=2, negatives=3, low=10, high=90)
    assert sorted(map(tuple, found.collect())) == plain(rows, lambda i: i < 10, 2, 3, 10, 90)


def test_no_rows(llm):
    assert hn.hard_negatives(frame(llm, []), F.col("vec_id") % 5 == 0).collect() == []
    assert hn.hard_negatives(frame(llm, [(1, [0.1], 1)]), F.col("vec_id") % 5 == 0).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_its_sql(llm, sf):
    path = f"/root/testdata/{sf}"
    assert difference(hn.op12_hard_negatives(llm, path), hn.ORACLE, duck(path)) is None
