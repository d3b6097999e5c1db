import hashlib
import math
import re
from collections import Counter

import pytest

from stratalake.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "mail a.b@c.de, x@y.z_q@r.s and a@b@c.d or @no.pe e@nodot", "1.2.3.4 999.1.1.1 1.2.3.4.5 001.02.003.255 256.0.0.1 1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 3714496353984311234 41111111111111110000 7", "+1 (743) 555-3824 +12 34 +1234567890123456 + 1 +1(((",
    "É\U0001F600 a@b.c\n\n+1 555 123 4567 é", None, "", "\n", "1 2 3 4 5 6 7 8 9 " * 4000, "a" * 50000 + "@", "9." * 20000, "5500005555555559",
]


def luhn(d):
    return sum(sum(divmod(int(c) * 2, 10)) if i % 2 else int(c) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in BASE.items():
        if "@" not in text and kind == "email":
            continue
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else 0,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def plain_terms(texts, disclosure=pii.DISCLOSURE, support=pii.SUPPORT):
    """Spans of the disclosing words of each text, with their replacements."""
    word = lambda s: re.findall(r"[^\W\d_]+", s.lower())
    n, n_t, n_c, n_ct, lines = 0, Counter(), Counter(), Counter(), []
    for r, text in enumerate(texts):
        if text is None:
            continue
        at = 0
        for line in text.split("\n"):
            n += 1
            n_t.update(set(word(line)))
            found = plain_base(line)
            entities = {f"{k}:{line[a:b].lower()}" for k, a, b in found}
            bare = line
            for k in BASE:
                bare = re.sub(BASE[k], " ", bare) if entities else bare
            n_c.update(entities)
            n_ct.update((c, t) for c in entities for t in set(word(bare)))
            lines.append((r, at, line, entities, found))
            at += len(line) + 1
    n_g, n_cg = Counter(), Counter()
    for t, k in n_t.items():
        n_g[t[:3]] += k
    for (c, t), k in n_ct.items():
        n_cg[c, t[:3]] += k
    tells = lambda both, c, alone: math.log(n * both / (n_c[c] * alone)) >= disclosure * math.log(n / n_c[c]) - 1e-9
    out = [[] for _ in texts]
    for r, at, line, entities, found in lines:
        told = {}
        for c in entities:
            for t in set(word(line)):
                if n_ct[c, t] >= support and n_c[c] < n and tells(n_ct[c, t], c, n_t[t]):
                    wide = len(t) > 6 and not tells(n_cg[c, t[:3]], c, n_g[t[:3]])
                    told.setdefault(t, set()).add(t[:3] + "*" if wide else "[TERM]")
        for m in re.finditer(r"[^\W\d_]+", line):
            if m[0].lower() in told and not any(a < m.end() and m.start() < b for _, a, b in found):
                choice = told[m[0].lower()]
                out[r].append((at + m.start(), at + m.end(), choice.pop() if len(choice) == 1 else "[TERM]") if len(choice) == 1 else (at + m.start(), at + m.end(), "[TERM]"))
                told[m[0].lower()] = {out[r][-1][2]}
    return out


def expected(doc_id, text, terms):
    base = plain_base(text or "")
    count = Counter(k for k, *_ in base)
    written = [f"{k}:{a}:{b}" for k, a, b in base]
    digest = hashlib.sha256(",".join(written).encode()).hexdigest()
    return (doc_id, *[count[k] for k in BASE], digest, ",".join(written + [f"term:{a}:{b}" for a, b, _ in terms]), len(terms))


def test_base_spans_are_the_contract(documents, rows):
    got = rows(pii.personal_data(documents(list(enumerate(TEXTS)))).drop("spans", "n_term"))
    assert got == sorted((tuple(expected(i, t, [])[:6]) for i, t in enumerate(TEXTS)), key=str)


STORY = [
    (1, "Zorblax keeps watch at ann@x.org\nthe rain falls on the old town"), (2, "write to Ann@x.org, Zorblax\nthe sun shines"),
    (2, "write to Ann@x.org, Zorblax\nthe sun shines"), (3, "the garden of unbelievable roses ann@x.org unbelievable"), (4, "the unbeaten team and the unbent and unbolted doors"),
    (5, "unbelievable ann@x.org and bob@y.org the"), (6, "bob@y.org the unbeaten team"), (7, "the plain line\nthe other\nthe third"), (8, None), (None, "the end"),
]


def test_disclosing_words_follow_the_formula(documents, rows):
    terms = plain_terms([t for _, t in STORY])
    assert any(terms) and {r for t in terms for *_, r in t} >= {"[TERM]"}
    got = rows(pii.personal_data(documents(STORY)))
    assert got == sorted((expected(i, t, x) for (i, t), x in zip(STORY, terms)), key=str)


@pytest.mark.parametrize("disclosure", [0.5, 0.9, 1.0])
def test_sanitised_texts(documents, disclosure):
    terms = plain_terms([t for _, t in STORY], disclosure)
    want = []
    for (_, text), found in zip(STORY, terms):
        spans = sorted([(a, b, f"[{k.upper()}]") for k, a, b in plain_base(text or "")] + found, reverse=True)
        for a, b, r in spans:
            text = text[:a] + r + text[b:]
        want.append(text)
    docs = documents(STORY)
    out = pii.sanitised(docs, disclosure=disclosure)
    assert out.columns == docs.columns
    got = out.collect()
    assert sorted((r.text for r in got), key=str) == sorted(want, key=str)
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_overlapping_spans_of_two_kinds_are_replaced_once(documents):
    docs = documents([(1, "call +1.2.3.4 555 6666 now"), (2, "at a@1.2.3.4 end")])
    assert sorted(r.text for r in pii.sanitised(docs).collect()) == ["at [EMAIL] end", "call [PHONE] now"]


def test_an_entity_on_one_line_takes_part(documents):
    docs = documents([(1, "the plain Quillon at solo@x.org"), *[(k, "the plain line") for k in range(2, 40)]])
    (found,) = pii.personal_data(docs).filter("n_email = 1").collect()
    assert found.n_term == 2 and found.spans.endswith(",term:10:17,term:18:20")
    assert [r.text for r in pii.sanitised(docs).collect() if "[EMAIL]" in r.text] == ["the plain [TERM] [TERM] [EMAIL]"]


def test_empty_table(documents):
    assert pii.personal_data(documents([])).count() == 0 and pii.sanitised(documents([])).count() == 0


def test_query_against_brute_force(llm, sf_dir, rows):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").collect()
    terms = plain_terms([r.text for r in docs])
    assert rows(pii.op3_personal_data(llm, sf_dir)) == sorted((expected(r.doc_id, r.text, t) for r, t in zip(docs, terms)), key=str)
