import hashlib
import random

import pytest

from stratalake.llm import fingerprints as P

LONG = "".join(random.Random(3).choice("abc é\U0001F600\n") for _ in range(70_000))


def plain_hash(text):
    return tuple(sum((ord(c) + 1) * pow(b, i, p) for i, c in enumerate(text)) % p for p, b in zip(P.PRIMES, P.BASES))


@pytest.mark.parametrize("block", [1 << 16, 8])
def test_spans_and_extensions(monkeypatch, block):
    monkeypatch.setattr(P, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(60):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 40)))
        b = a[: rng.randint(0, 40)] + "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        x, y = P.PrefixHash(a), P.PrefixHash(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = rng.randint(0, min(len(a) - i, len(b) - j))
        assert x.span(i, n) == plain_hash(a[i : i + n]) and x.equal(i, y, j, n) == (a[i : i + n] == b[j : j + n])
        ahead = next((k for k in range(len(a) - i) if j + k >= len(b) or a[i + k] != b[j + k]), len(a) - i)
        back = next((k for k in range(i) if k >= j or a[i - 1 - k] != b[j - 1 - k]), i)
        assert x.extension(i, y, j) == ahead and x.extension(i, y, j, backwards=True) == min(back, j)


def test_long_texts():
    hashed = P.PrefixHash(LONG)
    other = P.PrefixHash(LONG[:68_000] + "#" + LONG[68_001:])
    assert hashed.extension(0, other, 0) == 68_000 and hashed.extension(70_000, other, 70_000, backwards=True) == 1_999
    assert 0.85 < P.likeness(P.fingerprint(hashed), P.fingerprint(other)) < 1


def test_likeness():
    print_ = lambda t: P.fingerprint(P.PrefixHash(t))
    a = LONG[:3000]
    assert P.likeness(print_(a), print_(a)) == 1 == P.likeness(print_(""), print_(""))
    assert P.likeness(print_(a), print_("")) == 0 and P.likeness(print_(a), print_("z" * 3000)) == 0
    assert 0.4 < P.likeness(print_(a), print_(P.edited(a, "z" * 3000))) <= 0.5
    assert 0.85 < P.likeness(print_(a), print_(a + "!" * 100)) < 1 and 0.85 < P.likeness(print_(a), print_("!" * 100 + a)) < 1
    assert 0 < P.likeness(print_("aaaa"), print_("aaaaa")) < 1


def plain_inside(a, b):
    x, y = ({t[i : i + P.SPAN] for i in range(len(t) - P.SPAN + 1)} for t in (a, b))
    return len(x & y) / max(len(x), len(y))


@pytest.mark.parametrize("count", [20, 1000, 30_000])
def test_near_copies_with_edits_anywhere(count):
    rng = random.Random(count)
    print_ = lambda t: P.fingerprint(P.PrefixHash(t))
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 9))) for _ in range(count)]
    text, other = " ".join(words), " ".join(rng.sample(words, count))
    ends = " ".join([words[0], "#", *words[2:-2], "#", words[-1]])
    framed = f"page 7 of 9\n{text}\nall rights kept"
    few = " ".join("#" if k % 50 == 25 else w for k, w in enumerate(words))
    for new in (ends, framed, few):
        found = P.likeness(print_(text), print_(new))
        assert found == P.likeness(print_(new), print_(text)) and abs(found - plain_inside(text, new)) < 0.15
        assert found > 0.7
    assert P.likeness(print_(text), print_(other)) < 0.1


def test_span_hashes_at_every_place(monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 64)
    text = LONG[:500]
    want = {P.PrefixHash(text[i : i + P.SPAN]).inner()[0] for i in range(len(text) - P.SPAN + 1)}
    assert set(P.PrefixHash(text).inner()) == want and len(P.PrefixHash(text[: P.SPAN - 1]).inner()) == 0


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        new = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        prints = [P.fingerprint(P.PrefixHash(t)) for t in (text, new, after)]
        common = lambda x, y: next((i for i, (c, d) in enumerate(zip(x, y)) if c != d), min(len(x), len(y)))
        out.append((doc_id, len(text), hashlib.sha256(new.encode()).hexdigest(), prints[0], prints[1], P.likeness(prints[0], prints[1]), P.likeness(prints[0], prints[2]), common(text, new), common(text, after)))
    return sorted(out, key=str)


def test_neighbours_nulls_and_ends(documents, rows):
    docs = [(7, "seven words in a row"), (3, "é\U0001F600x"), (-4, ""), (12, None), (None, "no id"), (5, LONG), (6, "seven words in a row")]
    assert rows(P.neighbour_fingerprints(documents(docs))) == expected(docs)
    assert rows(P.neighbour_fingerprints(documents(docs[:1]))) == expected(docs[:1])
    assert P.neighbour_fingerprints(documents([])).count() == 0


def test_repeated_ids_each_have_a_next_one(documents):
    found = P.neighbour_fingerprints(documents([(1, f"text {k % 3}") for k in range(50)] + [(2, "end")])).collect()
    assert len(found) == 51 and sum(r.near_next == 1 for r in found) == 47


def test_query_against_brute_force(llm, sf_dir, rows):
    docs = [tuple(r) for r in llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(P.op7_document_fingerprints(llm, sf_dir)) == expected(docs)
