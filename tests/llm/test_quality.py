import zlib

import numpy as np
import pytest

from stratalake.llm import quality as Q


def auc(score, label):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable") + 1
    ones = label == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() + 1) / 2) / (ones.sum() * (~ones).sum())


@pytest.fixture
def labels(llm):
    rows = [(i, int(i % 7 != 0), 0) for i in range(400)] + [(900, None, 1), (None, 1, 0)]
    return llm.createDataFrame(rows, "doc_id long, quality int, toxic int")


GOOD = "The quiet river runs, and the {} boats wait for rain in the old harbour."
BAD = "BUY!! NOW!! {} *** $$$ BUY!! NOW!!"


@pytest.fixture
def docs(documents):
    return documents([(i, (BAD if i % 7 == 0 else GOOD).format(i)) for i in range(500)] + [(500, None), (501, ""), (None, "x"), (502, "word " * 40000), (3, GOOD), (3, GOOD)])


def test_tables_learn_a_pairwise_rule():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.5)).astype(float)
    model = Q.fit(x, y)
    assert (0, 2) in model.pairs and ((model.score(x) > 0.5) == y).mean() > 0.9
    by_hand = [model.base + sum(t[np.searchsorted(e, v, "right")] for t, e, v in zip(model.tables, model.edges, r)) for r in x[:5]]
    cut = lambda r, j: np.searchsorted(model.edges[j], r[j], "right") * Q.COARSE // (len(model.edges[j]) + 1)
    by_hand = [b + sum(t[cut(r, i), cut(r, j)] for (i, j), t in model.pairs.items()) for b, r in zip(by_hand, x[:5])]
    assert np.allclose(by_hand, model.logit(x[:5]))


def test_scores_and_rejects(docs, labels):
    got = {r.doc_id: r for r in Q.quality_scores(docs, labels).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(500)) and got[None].held_out is False
    assert all(got[i].predicted == (i % 7 != 0) == (got[i].score >= 0.3) for i in range(500))
    assert 0 <= got[500].score == got[501].score <= 1 and Q.quality_scores(docs, labels).count() == docs.count()
    kept = Q.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} & set(range(500)) == {i for i in range(500) if i % 7}


def test_empty_tables(docs, documents, labels, llm):
    none = llm.createDataFrame([], labels.schema)
    assert Q.quality_scores(documents([]), labels).count() == 0 and Q.accepted(documents([]), labels).count() == 0
    assert {r.score for r in Q.quality_scores(docs, none).collect()} == {0.5}


def test_held_out_documents_of_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in llm.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in Q.op6_quality_classifier(llm, sf_dir).collect() if r.held_out and r.doc_id in labels]
    score, label = np.array([r.score for r in rows]), np.array([labels[r.doc_id] for r in rows])
    assert auc(score, label) > 0.9
    assert np.mean([(r.predicted == labels[r.doc_id]) for r in rows]) > 0.9
