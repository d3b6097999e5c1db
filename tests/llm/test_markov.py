import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalake.llm import markov
from stratalake.llm.labelled import held_out
from stratalake.llm.markov import Lanes, Model


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_base(rows, held):
    """The base of the contract: ``(n_tokens, n_known, train_tokens, base_score)`` of each row."""
    counts = Counter(t for i, text in rows if not held(i) for t in [*plain_words(text), None])
    total = sum(counts.values())
    out = []
    for _, text in rows:
        tokens = [*plain_words(text), None]
        out.append((len(tokens), sum(t in counts for t in tokens), total, sum(math.log10((counts[t] + 1) / (total + len(counts) + 1)) for t in tokens)))
    return out


def random_model(classes, states, seed=0):
    rng = np.random.default_rng(seed)
    shares = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(rng.random(shape))
    return Model(shares(states), shares(states, states), np.ascontiguousarray(shares(states, classes).T))


def by_paths(model, text):
    """Probability, and expected first states, moves and emissions, summed over all ways through the states."""
    states = range(len(model.start))
    total, first, moved, emitted = 0.0, np.zeros(len(model.start)), np.zeros_like(model.move), np.zeros_like(model.emit)
    for path in itertools.product(states, repeat=len(text)):
        p = model.start[path[0]] * np.prod([model.emit[c, s] for c, s in zip(text, path)]) * np.prod([model.move[a, b] for a, b in zip(path, path[1:])])
        total += p
        first[path[0]] += p
        for a, b in zip(path, path[1:]):
            moved[a, b] += p
        for c, s in zip(text, path):
            emitted[c, s] += p
    return total, first / total, moved / total, emitted / total


@pytest.mark.parametrize("section, held", [(1, 1 << 21), (5, 12), (5, 0), (1 << 19, 1 << 21)])
def test_recursions_are_sums_over_all_paths(section, held, monkeypatch):
    monkeypatch.setattr(markov, "SECTION", section)
    monkeypatch.setattr(markov, "HELD", held)
    rng, model = np.random.default_rng(1), random_model(4, 3)
    texts = [rng.integers(0, 4, n).astype("<u2") for n in (3, 1, 7, 5, 7, 1, 2)]
    lanes = Lanes.of(texts)
    plain = [by_paths(model, t) for t in texts]
    assert np.allclose(model.log_probability(lanes), [math.log(p[0]) for p in plain])
    first, moved, emitted, total = model.expected(lanes)
    assert np.isclose(total, sum(math.log(p[0]) for p in plain))
    for found, k in ((first, 1), (moved, 2), (emitted, 3)):
        assert np.allclose(found, sum(p[k] for p in plain))


def test_a_very_long_text_takes_bounded_sections(monkeypatch):
    monkeypatch.setattr(markov, "SECTION", 1000)
    monkeypatch.setattr(markov, "HELD", 5000)
    text = np.random.default_rng(2).integers(0, 4, 60_000).astype("<u2")
    model = random_model(4, 3)
    lanes = Lanes.of([text, text[:10]])
    assert max(lanes.starts[b] - lanes.starts[a] for a, b in lanes.sections()) <= 1001
    assert np.isclose(model.expected(lanes)[2].sum(), 60_010)
    assert np.isfinite(model.log_probability(lanes)).all()


def corpus(n=260, seed=3):
    rng = random.Random(seed)
    kinds = [["the", "of", "And", "house", "walking"], ["der", "und", "Haus", "gehen", "große"]]
    rows = [(k, " ".join(rng.choice(kinds[k % 2]) + rng.choice(["", "", "", "s", str(rng.randint(0, 30))]) for _ in range(rng.randint(0, 40)))) for k in range(n)]
    return rows + [(1000, None), (1001, ""), (1002, "x" * 5000 + " the\x0bof and\x1fé"), (1003, "the " * 9000), (5, rows[5][1]), (None, "der und")]


def test_base_and_counts_are_the_contract(llm, documents):
    rows = corpus()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    found = markov.language_model_scores(documents(rows), held_out(F.col("doc_id"), 7, 2), frequent=20, rare=4).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    expected = sorted(((i, held(i), *p) for (i, _), p in zip(rows, plain_base(rows, held))), key=key)
    found = sorted(map(tuple, found), key=key)
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    assert np.allclose([r[5] for r in found], [r[5] for r in expected], rtol=1e-12)
    assert sum(r[6] > r[5] for r in found) > 0.9 * len(found)


def test_score_is_the_probability_of_classes_and_of_words_in_them(llm, documents):
    rows = corpus(80)
    docs = documents(rows)
    learning = docs.filter("doc_id % 3 <> 0")
    counts = markov.count(learning, 15, 4)
    plain = Counter(t for i, text in rows if i is not None and i % 3 for t in [*plain_words(text), ""])
    own = sorted((w for w in plain if w and len(w.encode()) <= 64), key=lambda w: (-plain[w], w))[:15]
    assert list(counts.classes.frequent) == [w.encode() for w in own]
    texts = markov.stored(markov.encoded(docs, counts.classes, "doc_id", "text", F.lit(False)), "encoded")
    model, history = markov.train(texts.filter("doc_id % 3 <> 0"), counts.share, 2, 3)
    assert history == sorted(history)
    place = {w: k for k, w in enumerate(own)} | {"": 15}
    shared = lambda w: 16 + zlib.crc32(w.encode()[-2:]) % 4
    members = {c: [w for w in plain if w not in place and shared(w) == c] for c in range(16, 20)}
    expected = []
    for i, text in rows:
        total, state = 0.0, None
        for w in [*plain_words(text), ""]:
            code = place.get(w, shared(w))
            state = (model.start if state is None else state @ model.move) * model.emit[code]
            total += math.log10(state.sum())
            state = state / state.sum()
            if code > 15:
                total += math.log10((plain[w] + 1) / (sum(plain[m] for m in members[code]) + len(members[code]) + 1))
        expected.append((str(i), total))
    found = sorted((str(r.doc_id), r.score) for r in markov.scored(texts, texts, counts, model).collect())
    assert [f[0] for f in found] == [e[0] for e in sorted(expected)]
    assert np.allclose([f[1] for f in found], [e[1] for e in sorted(expected)], rtol=1e-9)
    assert np.allclose(model.emit.sum(axis=0), 1) and np.allclose(model.move.sum(axis=1), 1) and np.isclose(model.start.sum(), 1)


@pytest.mark.parametrize("chunk", [1, 300])
def test_parts_of_a_task_add_up(llm, documents, monkeypatch, chunk):
    docs = documents(corpus(60))
    whole = [(r.doc_id, r.n_known, r.base_score, r.score) for r in markov.language_model_scores(docs, F.col("doc_id") % 4 == 0, states=2, passes=2).collect()]
    monkeypatch.setattr(markov, "CHUNK", chunk)
    monkeypatch.setattr(markov, "COUNTED", 100)
    monkeypatch.setattr(markov, "REMEMBERED", 3)
    parts = [(r.doc_id, r.n_known, r.base_score, r.score) for r in markov.language_model_scores(docs, F.col("doc_id") % 4 == 0, states=2, passes=2).collect()]
    assert np.allclose(np.array(sorted(whole, key=str)[:-1], float), np.array(sorted(parts, key=str)[:-1], float))


def test_texts_of_a_length_are_dealt_together(llm):
    rows = [(k, bytes(2 * (1 + k % 3) * (100 if k % 10 == 0 else 1))) for k in range(200)]
    texts = llm.createDataFrame(rows, "key long, codes binary")
    dealt = markov.by_length(texts, 300)
    assert sorted(map(tuple, dealt.collect())) == rows
    sizes = dealt.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("codes") / 2).alias("n")).collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) < 2500
    assert markov.by_length(texts.limit(0)).count() == 0


def test_nothing_to_learn_from(llm, documents):
    assert markov.language_model_scores(documents([]), F.lit(False)).collect() == []
    held = markov.language_model_scores(documents([(1, "a b"), (2, None)]), F.lit(True)).collect()
    assert sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in held) == [(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)]
    assert all(r.score < 0 for r in held)
    with pytest.raises(ValueError):
        markov.language_model_scores(documents([]), F.lit(False), frequent=1 << 16)


def test_ids_of_any_type(llm):
    docs = llm.createDataFrame([("x", "a b"), ("y", "a")], "doc_id string, text string")
    found = markov.language_model_scores(docs, F.lit(False), states=1, passes=1)
    assert found.schema["doc_id"].dataType.simpleString() == "string" and found.count() == 2


def test_groups_of_texts_add_up_to_the_whole(monkeypatch):
    monkeypatch.setattr(markov, "LANES", 3)
    rng, model = np.random.default_rng(5), random_model(4, 3)
    texts = [rng.integers(0, 4, n).astype("<u2") for n in (3, 1, 40, 5, 5, 2, 9, 1)]
    groups = list(markov._side_by_side(texts))
    assert [len(g) for g, _ in groups] == [3, 3, 2] and sorted(k for g, _ in groups for k in g) == list(range(8))
    whole, scores = model.expected(Lanes.of(texts)), np.empty(8)
    parts = [model.expected(lanes) for _, lanes in groups]
    for k in range(4):
        assert np.allclose(sum(p[k] for p in parts), whole[k])
    for some, lanes in groups:
        scores[some] = model.log_probability(lanes)
    assert np.allclose(scores, model.log_probability(Lanes.of(texts)))
