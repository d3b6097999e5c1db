import random
import re

import numpy as np
import pytest
import xxhash

from stratalake.llm import simhash
from stratalake.llm.components import connected_components


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, distance=4):
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(values))]


def clusters(n, seed):
    rng, out = random.Random(seed), []
    while len(out) < n:
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 60])):
            out.append(centre)
            for _ in range(rng.randint(0, 3)):
                out[-1] ^= 1 << rng.randrange(64)
            if rng.random() < 0.3:
                centre = out[-1]
    return out[:n]


TEXTS = ["", "one", "A b", "a B  c\td\n", "É é", "a " * 3000, "x\x0by z\x1fw q", None, "The quick brown fox jumps over the lazy dog " * 40]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint_is_the_contract(text):
    assert simhash.simhash(text) == plain_fingerprint(text)


def test_fingerprint_over_several_blocks_of_hashes(monkeypatch):
    monkeypatch.setattr(simhash, "HASHES", 7)
    assert simhash.simhash(TEXTS[-1]) == plain_fingerprint(TEXTS[-1])


def test_gray_rank_inverts_the_gray_code():
    n = np.arange(5000, dtype=np.uint64)
    assert (simhash.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("pairs", [1 << 20, 300])
def test_index_links_what_brute_force_links(pairs, monkeypatch):
    monkeypatch.setattr(simhash, "PAIRS", pairs)
    sets = [sorted(set(clusters(n, n)), key=lambda v: int(simhash.gray_rank(np.array([v], np.uint64))[0])) for n in (1, 3, 70, 700)]
    groups = np.repeat(np.arange(4), [len(s) for s in sets])
    label = simhash.GrayIndex(groups, np.array([v for s in sets for v in s], np.uint64)).link()
    expected, base = [], 0
    for s in sets:
        expected += [base + x for x in plain_components(s)]
        base += len(s)
    assert label.tolist() == expected


@pytest.mark.parametrize("cell", [16_384, 16])
def test_distributed_links_give_all_components(llm, cell):
    values = sorted(set(clusters(500, 5)) | set(range(40)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(llm.createDataFrame([(v,) for v in signed], "f long"), cell)
    root = {r.u: r.root for r in connected_components(links).collect()}
    groups = {}
    for v, label in zip(signed, plain_components(values)):
        groups.setdefault(label, set()).add(v)
    assert all(root.get(v, v) == min(g) for g in groups.values() for v in g)


def test_chains_and_stars_become_components(llm):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7), (3, 2), (3, 2)]
    found = dict(connected_components(llm.createDataFrame(edges, "u long, v long")).collect())
    assert found == {i: 0 for i in range(1, 61)} | {i: 100 for i in range(101, 160)}
    assert connected_components(llm.createDataFrame([], "u long, v long")).count() == 0


def test_rows_nulls_and_repeats(documents, rows):
    long = " ".join(str(i * i) for i in range(900))
    docs = documents([(5, long), (3, long + " tail"), (3, long + " tail"), (9, None), (8, " "), (7, "other words"), (None, "other words"), (None, "alone " * 9)])
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    got = [(r.doc_id, r.component_id) for r in found.collect()]
    assert sorted(got, key=str) == sorted([(5, 3), (3, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, 7), (None, None)], key=str)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([3, 8, 7, None], key=str)
    empty = documents([])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_query_against_brute_force(llm, sf_dir):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in docs]
    label = plain_components(prints)
    first = {}
    for r, x in zip(docs, label):
        first[x] = min(first.get(x, r.doc_id), r.doc_id)
    expected = sorted((r.doc_id, f"{p:016x}", first[x]) for r, p, x in zip(docs, prints, label))
    got = sorted(tuple(r) for r in simhash.op1_simhash_near_dedup(llm, sf_dir).select("doc_id", "fingerprint", "component_id").collect())
    assert got == expected
