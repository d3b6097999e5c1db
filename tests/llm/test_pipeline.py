import numpy as np
import pytest

import corpus_pipeline as C
from stratalake.llm import mixing, quality
from test_decontamination import brute
from test_pii import plain_base, plain_terms
from test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def stages(llm, sf_dir, tmp_path_factory):
    """Rows before and after each stage."""
    root, docs = tmp_path_factory.mktemp("stages"), llm.read.parquet(f"{sf_dir}/documents.parquet")
    tables, columns = [docs.collect()], docs.columns
    for k, (_, stage) in enumerate(C.STAGES):
        out = stage(llm, docs, sf_dir)
        assert out.columns == columns or k == 4
        out.write.parquet(f"{root}/{k}")
        docs = llm.read.parquet(f"{root}/{k}")
        tables.append(docs.collect())
    return tables


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality_keeps_what_the_query_accepts(stages, llm, sf_dir):
    scores = quality.op6_quality_classifier(llm, sf_dir).collect()
    assert ids(stages[1]) == ids([r for r in scores if r.predicted])


def test_one_document_of_each_group_stays(stages):
    before = sorted(stages[1], key=lambda r: r.doc_id)
    label = plain_components([plain_fingerprint(r.text) for r in before])
    first = {}
    for r, x in zip(before, label):
        first.setdefault(x, r.doc_id)
    assert ids(stages[2]) == sorted(first.values())


def test_contaminated_documents_go(stages, llm, sf_dir):
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    hit = {x[0] for x in brute([(r.doc_id, r.text) for r in stages[2]], items) if x[5]}
    assert ids(stages[3]) == sorted({r.doc_id for r in stages[2]} - hit)


def test_personal_data_are_replaced(stages):
    terms = plain_terms([r.text for r in stages[3]])
    after = {r.doc_id: r for r in stages[4]}
    assert ids(stages[3]) == ids(stages[4])
    for r, found in zip(stages[3], terms):
        text = r.text
        for a, b, new in sorted([(a, b, f"[{k.upper()}]") for k, a, b in plain_base(text)] + found, reverse=True):
            text = text[:a] + new + text[b:]
        assert after[r.doc_id].text == text and after[r.doc_id].n_chars == len(text) and not plain_base(after[r.doc_id].text)


def test_the_mixture_comes_close_to_its_targets(stages, llm, sf_dir):
    tokens = {}
    for r in stages[5]:
        tokens[r.lang] = tokens.get(r.lang, 0) + len(r.text.split())
    shares = np.array([tokens.get(d, 0) for d in sorted(mixing.TARGETS)]) / sum(tokens.values())
    assert np.abs(shares - [mixing.TARGETS[d] for d in sorted(mixing.TARGETS)]).max() < 0.15
    copies = {}
    for r in stages[5]:
        copies.setdefault(r.doc_id, []).append((r.copy, r.rate))
    assert all(sorted(c for c, _ in v) == list(range(1, len(v) + 1)) and abs(len(v) - v[0][1]) < 1 for v in copies.values())


def test_run_gives_the_last_stage(stages, llm, sf_dir):
    assert sorted(map(tuple, C.run(llm, sf_dir).collect())) == sorted(map(tuple, stages[5]))
