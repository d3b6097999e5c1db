import random
import zlib

import numpy as np
import pytest

from stratalake.llm import toxicity as X


def brute(walk):
    """Maximal segments by their definition: the best one first, then the same on both sides of it."""
    if not walk:
        return []

    def split(a, b):
        best = (0, None, None)
        sums = np.concatenate(([0], np.cumsum(walk[a:b])))
        for i in range(b - a):
            j = int(np.argmax(sums[i + 1 :])) + i + 1
            if sums[j] - sums[i] > best[0] + 1e-9:
                best = (sums[j] - sums[i], a + i, a + j)
        if best[1] is None:
            return []
        return split(a, best[1]) + [(best[1], best[2] - 1, best[0])] + split(best[2], b)

    return split(0, len(walk))


@pytest.mark.parametrize("seed", range(40))
def test_passages_are_the_maximal_segments(seed):
    rng = random.Random(seed)
    gains = [rng.choice([None, None, rng.uniform(0.1, 4), rng.uniform(0.1, 0.5)]) for _ in range(rng.randint(0, 60))]
    walk = [-0.4 if g is None else g - 0.4 for g in gains]
    at = [k for k, g in enumerate(gains) if g is not None]
    got = X.passages(at, [gains[k] for k in at], 0.4)
    want = brute(walk)
    assert len(got) == len(want) and np.allclose([s for *_, s in got], [s for *_, s in want])
    assert all(abs(sum(walk[a : b + 1]) - s) < 1e-9 for a, b, s in got)


def test_rate_solves_the_defining_equation():
    gain, share = np.array([3.0, 1.0, 0.5]), np.array([0.001, 0.01, 0.02])
    rate = X._fall_rate(gain, share)
    assert (share * np.exp(rate * (gain - X.DRIFT))).sum() + (1 - share.sum()) * np.exp(-rate * X.DRIFT) == pytest.approx(1, abs=1e-6)


WORDS = "river boat rain stone garden window bread morning quiet street paper winter music table summer letter".split()


def body(i):
    rng = random.Random(i)
    return " ".join(rng.choice(WORDS) for _ in range(120)) + (" you grobnik fleggish wuntz " if i % 5 == 0 else " ") + " ".join(rng.choice(WORDS) for _ in range(40))


@pytest.fixture
def labels(llm):
    return llm.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)] + [(900, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")


@pytest.fixture
def docs(documents):
    return documents([(i, body(i)) for i in range(500)] + [(500, None), (501, ""), (None, "x"), (502, "word " * 40000), (3, body(3)), (3, body(3)), (503, "GROBNIK!! Fleggishes wuntz")])


def test_scores(docs, labels):
    found = X.toxicity_scores(docs, labels).collect()
    got = {r.doc_id: r for r in found}
    assert len(found) == docs.count() and all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in range(500))
    assert all(got[i].predicted == (i % 5 == 0) == (got[i].score >= 0.3) for i in range(500))
    assert got[503].predicted == 1 and got[502].predicted == 0 and 0 <= got[500].score == got[501].score == got[None].score < 0.3


def test_passages_of_documents(docs, labels):
    model = X.train(docs, labels)
    spans = {r.doc_id: (r.first_token, r.last_token) for r in X.toxic_passages(docs.filter("doc_id < 100"), model).collect()}
    words = {i: X.tokens(body(i)) for i in range(0, 100, 5)}
    assert set(spans) == set(words) and all("grobnik" in words[i][a : b + 1] and b - a < 12 for i, (a, b) in spans.items())


def test_empty_tables(docs, documents, labels, llm):
    assert X.toxicity_scores(documents([]), labels).count() == 0
    assert {r.score for r in X.toxicity_scores(docs, llm.createDataFrame([], labels.schema)).collect()} == {0.5}


def test_held_out_documents_of_the_table(llm):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in llm.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [(r.predicted, labels[r.doc_id]) for r in X.op9_toxicity(llm, sf_dir).collect() if r.held_out and r.doc_id in labels]
    hit = sum(p and t for p, t in rows)
    assert hit / sum(t for _, t in rows) > 0.85 and hit / sum(p for p, _ in rows) > 0.85


def test_scores_of_tokens_by_hand(llm, documents):
    rng = random.Random(8)
    texts = [" ".join(rng.choice(WORDS + ["grobnik"] * (k % 3 == 0)) for _ in range(12)) for k in range(400)]
    labels = llm.createDataFrame([(k, 1, int(k % 3 == 0)) for k in range(400)], "doc_id long, quality int, toxic int")
    model = X.train(documents(list(enumerate(texts))), labels)
    learned = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 != 2]
    owned = {k: {x for w in X.tokens(texts[k]) for x in X.with_beginnings(w)} for k in learned}
    count = lambda x, y: sum(x in owned[k] for k in learned if int(k % 3 == 0) == y)
    n1, n0 = (sum(len(owned[k]) for k in learned if int(k % 3 == 0) == y) for y in (1, 0))
    expected = {}
    for x in set().union(*owned.values()):
        y1, y0 = count(x, 1), count(x, 0)
        a, whole = min(n1, n0) * (y1 + y0) / (n1 + n0), min(n1, n0)
        s = np.log((y1 + a) / (n1 + whole - y1 - a)) - np.log((y0 + a) / (n0 + whole - y0 - a)) - X.ERRORS * np.sqrt(1 / (y1 + a) + 1 / (y0 + a))
        if s > 0:
            expected[x] = (s, (y0 + 0.5) / (n0 + 1))
    assert "grobnik" in expected and set(model.scores) == set(expected)
    assert all(model.scores[x] == pytest.approx(s) for x, (s, _) in expected.items())
    gain, share = np.array(list(expected.values())).T
    assert (share * np.exp(model.rate * (gain - X.DRIFT))).sum() + (1 - share.sum()) * np.exp(-model.rate * X.DRIFT) == pytest.approx(1, abs=1e-6)
    clean = [(len(X.tokens(texts[k])), max((s for *_, s in model.passages(X.tokens(texts[k]))), default=0.0)) for k in learned if k % 3]
    reached = np.quantile([n * np.exp(-model.rate * s) for n, s in clean], X.QUANTILES)
    assert model.scale == pytest.approx(min(1.0, max(-np.log(1 - q) / u for q, u in zip(X.QUANTILES, reached))))
    for k in range(400):
        words = X.tokens(texts[k])
        x = np.array(model.evidence(words))
        assert model.score(x)[0] == pytest.approx(1 / (1 + np.exp(-(model.weights[0] + x @ model.weights[1:]))))


def test_sum_of_passages_is_the_least_likely_number():
    from math import exp, factorial, log

    normal = np.array([2.0, -1.0, 5.0, 0.5, 3.0])
    best = [5.0, 3.0, 2.0, 0.5]
    law = [sum(best[:r]) for r in range(1, 5)]
    assert X.sum_evidence(normal) == pytest.approx(max(-log(exp(-t) * t ** (r - 1) / (factorial(r) * factorial(r - 1)) * 2**r) for r, t in enumerate(law, 1)))
    assert X.sum_evidence(np.array([-1.0])) == X.sum_evidence(np.array([])) == 0


@pytest.fixture(scope="module")
def fitted(llm):
    """A model of the given documents, clean unlabelled texts, and whole words that are toxic beyond doubt."""
    docs, labels = (llm.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    model = X.train(docs, labels)
    clean = docs.join(labels.filter("toxic = 0"), "doc_id").filter("lang = 'en'").orderBy("doc_id").limit(600).collect()
    texts = [w for w in (X.tokens(r.text) for r in clean) if w and len(set(w)) > 0.2 * len(w)]
    rude = sorted((w for w in model.scores if not w.startswith("^")), key=lambda w: -model.scores[w])[:20]
    return model, texts, rude


def flagged(model, words):
    return model.score(np.array(model.evidence(words)))[0] >= X.THRESHOLD


def cut(texts, n, rng):
    out = []
    while len(out) < n:
        out += rng.choice(texts)
    return out[:n]


@pytest.mark.parametrize("length", [50, 500, 5000, 20_000])
def test_planted_words_are_found_at_any_length(fitted, length):
    model, texts, rude = fitted
    rng = random.Random(length)
    texts = [t for t in texts if not flagged(model, t)]
    caught = {}
    for planted in (1, 2, 3):
        found = 0
        for _ in range(60):
            words = cut(texts, length, rng)
            at = rng.randrange(len(words))
            words[at:at] = [x for _ in range(planted) for x in (rng.choice(rude), rng.choice(WORDS))]
            found += flagged(model, words)
        caught[planted] = found / 60
    assert caught[1] > 0.35 and caught[2] > 0.85 and caught[3] > 0.95, caught


@pytest.mark.parametrize("joined", [1, 5, 20, 60])
def test_joined_clean_texts_stay_clean(fitted, joined):
    model, texts, _ = fitted
    rng = random.Random(joined)
    wrong = np.mean([flagged(model, [w for _ in range(joined) for w in rng.choice(texts)]) for _ in range(100)])
    assert wrong <= 0.05
