import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from stratalake.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] or a[k:] == b[k + 1 :] or a[k + 1 :] == b[k:]


def plain_words(rows, shortest=7, least=2, every=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}


def plain_groups(counts, times=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    rows = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(rows, key=str)


def words(n, seed, letters="abé", shortest=7, longest=9):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest))) for _ in range(n)]


@pytest.mark.parametrize("text", [[0, 1, 0], [0, 1, 1, 0, 1, 1, 2, 0, 1, 2, 0], [0] + [3] * 70 + [0] + [3] * 71 + [0]])
def test_suffixes_are_in_order(text):
    order = spelling.suffix_order(np.array(text, np.uint16))
    assert order.tolist() == sorted(range(len(text)), key=lambda k: text[k:])


@pytest.mark.parametrize("letters, narrow", [("ab", 64), ("ab", 0), ("ab", 2), ("abcdefghÿ一", 64)])
def test_pairs_of_both_halves_are_all_pairs(letters, narrow, monkeypatch):
    monkeypatch.setattr(spelling, "NARROW", narrow)
    monkeypatch.setattr(spelling, "QUERIES", 17)
    vocabulary = sorted(set(words(250, 1, letters, 2, 9)))
    right = spelling.near_words(vocabulary, vocabulary, False)
    turned = [w[::-1] for w in vocabulary]
    left = spelling.near_words(turned, turned, True)
    assert len(set(right + left)) == len(right + left)
    assert set(right + left) == {(a, b) for a in vocabulary for b in vocabulary if one_edit(a, b)}


def test_queries_that_are_not_indexed():
    assert spelling.near_words(["abcdefg", "abcdefh"], ["abcdefx", "zzzzzzz"], True) == []
    turned = spelling.near_words(["gfedcba", "hfedcba"], ["xfedcba"], True)
    assert sorted(turned) == [("abcdefx", "abcdefg"), ("abcdefx", "abcdefh")]
    assert spelling.near_words([], ["abc"], False) == [] == spelling.near_words(["abc"], [], False)


@pytest.mark.parametrize("cell, shard", [(50_000, 200_000), (5, 40)])
def test_dealt_pairs_are_all_pairs(llm, cell, shard):
    vocabulary = sorted(set(words(300, 2)))
    frame = llm.createDataFrame([(w, k) for k, w in enumerate(vocabulary)], "word string, n long")
    found = sorted(map(tuple, spelling.near_pairs(frame, cell, shard).collect()))
    number = {w: k for k, w in enumerate(vocabulary)}
    assert found == sorted((a, b, number[b]) for a in vocabulary for b in vocabulary if one_edit(a, b))


def test_query_is_brute_force(llm, documents):
    rng = random.Random(5)
    base = words(30, 6, "abcdéÉxyz", 7, 12)
    rows = [(k, " ".join(rng.choice(base[: rng.randint(1, 30)]).title() + rng.choice(["", "x", "-", "9", "一"]) for _ in range(60))) for k in range(250)]
    rows += [(300, None), (301, ""), (302, "a" * 20_000), (303, "a" * 20_001 + " " + "a" * 20_000), (303, "a" * 20_001), (None, base[0])]
    counts = plain_words(rows)
    found = spelling.variant_groups(spelling.vocabulary(documents(rows), spelling.with_lost_letters()))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    expected = plain_groups(counts)
    assert len(expected) > 100 and any(r[1] for r in expected)
    assert sorted(map(tuple, found.collect()), key=str) == expected


def test_chains_end_at_the_last_form(llm):
    chain = ["aaaaaaa" + "b" * k for k in range(12)]
    frame = llm.createDataFrame([(w, 2**k) for k, w in enumerate(chain)], "word string, n long")
    found = {r.word: (r.form, r.root) for r in spelling.variant_groups(frame, 2).collect()}
    assert found == {w: (chain[k + 1] if k < 11 else None, chain[-1]) for k, w in enumerate(chain)}
    with pytest.raises(ValueError):
        spelling.variant_groups(frame, 1)


def test_no_words(llm, documents):
    empty = spelling.vocabulary(documents([(1, None), (2, "")]), spelling.with_lost_letters())
    assert spelling.variant_groups(empty).collect() == []


def test_texts_with_roots(llm, documents):
    rows = [(1, "Colour, colur\u0000 42 COLUR! x"), (2, None), (3, ""), (3, "colur")]
    groups = llm.createDataFrame([("colur", "colour"), ("colour", "colour")], "word string, root string")
    found = spelling.with_root_form(documents(rows), groups, "Count")
    assert sorted((r.doc_id, r._Count) for r in found.select("doc_id", "_Count").collect() if r._Count is not None) == [(1, "Colour, colour\u0000 42 colour! x"), (3, ""), (3, "colour")]
    assert found.count() == 4
