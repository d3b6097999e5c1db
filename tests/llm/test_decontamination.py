import hashlib
import re

import pytest

from compare import difference, duck
from stratalake.llm import decontamination as D

ITEMS = [(1, "One two, THREE four five six seven eight nine ten eleven twelve"), (10, "short item"), (2, "short item"), (3, None), (4, "..."), (5, "École É é 9x a b c d e f g")]
DOCS = [
    (1, "zero one two three four five six seven eight nine ten eleven"),
    (2, "a Short  item, short. ITEM short item"),
    (3, "École É é 9x a b c d e f"),
    (4, "école é é 9x a b c d e f"),
    (5, None), (6, ""), (7, "clean words only"), (7, "clean words only"), (None, "one two three four five six seven eight nine ten"),
    (8, "x " * 30000 + "short item"),
]


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    out = []
    for doc_id, text in docs:
        w, places, found = plain(text), set(), set()
        for item, body in items:
            b = plain(body)
            for i in range(max(0, len(b) - 9) if len(b) >= 10 else 0, -1, -1):
                window = b[i : i + 10]
                for at in range(len(w) - len(window) + 1) if window else ():
                    if w[at : at + len(window)] == window:
                        places |= set(range(at, at + len(window)))
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(places), len(found), digest, bool(places)))
    return sorted(out, key=str)


@pytest.fixture
def items(llm):
    return llm.createDataFrame(ITEMS, "item_id long, text string")


def test_contamination_is_the_contract(documents, items, rows):
    assert rows(D.contamination(documents(DOCS), items)) == brute(DOCS, ITEMS)


def test_without_broadcast_the_same(documents, items):
    docs = documents(DOCS)
    a, b = (D.hits(docs.fillna(-1, ["doc_id"]).distinct(), items, ["doc_id"], broadcast_bytes=n) for n in (1 << 20, 0))
    plan = b._jdf.queryExecution().toString()
    assert "ResolvedHint" not in plan and sorted(a.collect()) == sorted(b.collect())


def test_documents_and_spans_are_removed(documents, items):
    docs = documents(DOCS)
    kept = D.without_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect())) == [4, 5, 6, 7, 7]
    cut = {r.doc_id: r.text for r in D.without_spans(docs, items).collect()}
    assert cut[1] == "zero" and cut[2] == "a" and cut[3] == "" and cut[5] is None and cut[7] == "clean words only"
    assert len(cut) == 9


def test_empty_tables(documents, items, llm):
    none = llm.createDataFrame([], items.schema)
    assert D.contamination(documents([]), items).count() == 0
    assert not any(r.contaminated for r in D.contamination(documents(DOCS), none).collect())
    assert D.without_contaminated(documents(DOCS), none).count() == len(DOCS)


def test_query_against_sql(llm, sf_dir):
    assert difference(D.op8_benchmark_decontamination(llm, sf_dir), D.ORACLE, duck(sf_dir)) is None
