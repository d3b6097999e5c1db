import numpy as np
import pytest

from stratalake.llm import mixing as M

VOICES = {"de": "der hund und die katze gehen nach hause", "en": "the dog and the cat walk home together", "fr": "le chien et la chatte vont vers la maison"}
AIM = {"de": 0.5, "en": 0.2, "fr": 0.3}


@pytest.fixture
def docs(documents):
    many = [(i, " ".join([VOICES[("en", "en", "de", "fr")[i % 4]]] * (1 + i % 5))) for i in range(400)]
    return documents(many + [(400, None), (401, ""), (None, "the dog"), (402, "the " * 30000), (3, VOICES["fr"]), (3, VOICES["fr"]), (403, "der dog le chien"), (404, "zzz")])


@pytest.fixture
def labelled(llm):
    return llm.createDataFrame([(i, ("en", "en", "de", "fr")[i % 4]) for i in range(0, 200)] + [(5, "xx"), (None, "de"), (6, None)], "doc_id long, domain string")


def solve(p, n, t):
    """Long plain projected gradient."""
    w = n / n.sum()
    r = np.ones(len(n))
    step = 1 / ((w[:, None] * p * p).sum() + M.RIDGE)
    for _ in range(20_000):
        r = np.maximum(0, r - step * (p @ (p.T @ (w * r) - t) + M.RIDGE * (r - 1)))
    return r


def test_rates_meet_targets_and_brute_force(docs, labelled):
    got = M.document_rates(docs, labelled, AIM).collect()
    p, n = np.array([[r[f"p_{d}"] for d in sorted(AIM)] for r in got]), np.array([r.n_tokens for r in got], float)
    rate = np.array([r.rate for r in got])
    t = np.array([AIM[d] for d in sorted(AIM)])
    assert len(got) == docs.count() and (rate >= 0).all()
    assert np.abs(p.T @ (n / n.sum() * rate) - t).max() < 0.01
    assert np.abs(rate - solve(p, n, t)).max() < 0.02
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i][f"p_{('en', 'en', 'de', 'fr')[i % 4]}"] > 0.9 for i in range(400))
    assert by_id[400].n_tokens == 0 and by_id[400].p_en == by_id[401].p_en and 0.3 < by_id[400].p_en < 0.6


def test_mixture_has_the_wanted_tokens(docs, labelled):
    rates = M.document_rates(docs, labelled, AIM)
    out = M.mixed(docs.withColumnRenamed("count", "Rate"), labelled, AIM)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "Rate", "Fingerprint", "_rate", "copy"]
    rows = out.collect()
    want = sum(r.rate for r in rates.collect())
    assert abs(len(rows) - want) < 0.15 * want
    times = {}
    for r in rows:
        times.setdefault((r.doc_id, r.text), []).append(r._rate)
    assert all(abs(len(v) - v[0]) < 1 for k, v in times.items() if k[0] != 3)


def test_a_target_of_zero_takes_a_domain_out(docs, labelled):
    found = M.document_rates(docs, labelled, {"de": 1.0, "en": 0.0, "fr": 1.0}).collect()
    assert max(r.rate for r in found if r.p_en > 0.999) < 0.01
    with pytest.raises(ValueError):
        M.document_rates(docs, labelled, {"de": 0.0})


def test_empty_tables(docs, documents, labelled, llm):
    assert M.document_rates(documents([]), labelled, AIM).count() == 0 and M.mixed(documents([]), labelled, AIM).count() == 0
    none = llm.createDataFrame([], labelled.schema)
    assert {(r.p_de, r.p_en) for r in M.document_rates(docs, none, AIM).select("p_de", "p_en").collect()} == {(0.333, 0.333)}


def test_query_on_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in M.op4_mixing(llm, sf_dir).collect()}
    langs = {r.doc_id: r.lang for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    right = [max(M.TARGETS, key=lambda d: got[i][f"p_{d}"]) == lang for i, lang in langs.items()]
    assert len(got) == len(langs) and np.mean(right) > 0.95
    p, n, rate = (np.array([f(r) for r in got.values()]) for f in (lambda r: [r[f"p_{d}"] for d in sorted(M.TARGETS)], lambda r: float(r.n_tokens), lambda r: r.rate))
    assert np.abs(p.T @ (n / n.sum() * rate) - [M.TARGETS[d] for d in sorted(M.TARGETS)]).max() < 0.01
