import hashlib
import random
import re

import pytest

from stratalake.llm import secret_scan as S

CLASS = r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/=_-]{16,}"
SYLLABLES = "ther ing ation ed ly con pre ment able ous".split()


def word(rng):
    return "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 3)))


def body(i):
    rng = random.Random(i)
    text = " ".join(word(rng) for _ in range(60)) + " internationalmenting "
    if i % 4 == 0:
        text += f'api_key = "{rng.getrandbits(160):040x}" '
    if i % 4 == 1:
        text += f"see {rng.getrandbits(64)} "
    return text + "prepreprepreablement"


@pytest.fixture
def docs(documents):
    odd = [(300, None), (301, ""), (None, 'TOKEN: "A9f3kL0qZ7xW2mB5vN8c"'), (302, "a" * 40_000), (303, "short"), (3, body(3)), (3, body(3)), (304, "é " * 5 + "preprementmentably x"), (305, "thing 93f0a7c1e5b2948d60ab17fe")]
    return documents([(i, body(i)) for i in range(300)] + odd)


def test_candidates_are_placed(docs):
    texts = docs.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), m.start(), m.end(), m[0]) for r in texts for m in re.finditer(CLASS, r.text or ""))
    got = S.candidates(docs).collect()
    assert sorted((str(r.doc_id), r.start, r.end, r.value) for r in got) == want
    by = {r.doc_id: r.text for r in texts}
    assert all(r.before == by[r.doc_id][max(0, r.start - S.CONTEXT) : r.start][-len(r.before) or r.start :] and by[r.doc_id][r.end :].startswith(r.after) for r in got)


def test_assigned_values_leave_the_name_outside(documents):
    long = "9f8e7d6c5b4a39281706f5e4d3c2b1a0"
    texts = {
        f"API_KEY={long} end": long, f"get /x?access_token={long}&page=2": long, 'password = "Tr0ub4dor&3!"': "Tr0ub4dor&3!", "password: hunter2secret.": "hunter2secret",
        f"AWS_SECRET_ACCESS_KEY={long}": long, f"Authorization: Bearer {long}": long, '{"passwd": "a b,c"}': "a b,c", "config/of/the/database/password=x1;": "x1",
        f"{'a' * 140}_token=\"hunter2!x\"": "hunter2!x", f"token_{'b' * 80}=\"hunter2!x\"": "hunter2!x", "secret=a&b&c&page=2": "a&b&c", "secret=a&": "a&",
        f"key {long}== end": long + "==", "PASSWORD=\"open": None, "the author: Smith": None,
    }
    got = {r.doc_id: r for r in S.candidates(documents(list(enumerate(texts)))).collect()}
    for k, (text, value) in enumerate(texts.items()):
        assert (got[k].value if k in got and value else value) == value, text
        if value:
            assert text[got[k].start : got[k].end] == value and text[: got[k].start].endswith(got[k].before) and text[got[k].end :].startswith(got[k].after)
            assert (bool(re.search(S.NAMES, got[k].before)) or got[k].by_name) == (not text.startswith("key")), text


def test_pieces_and_cover_against_brute_force(docs):
    known = {r.word: r.n for r in S.dictionary(docs).collect()}
    lower = [set(re.findall(r"[^\W\d_]+", (r.text or "").lower())) for r in docs.select("text").collect()]
    counts = {w: sum(w in s for s in lower) for w in set().union(*lower)}
    assert known == {w: n for w, n in counts.items() if n >= S.KNOWN_IN}
    fours = {w[i : i + 4] for w in known for i in range(len(w) - 3)}
    found = S.with_features(S.candidates(docs), S.dictionary(docs)).select("value", "cover", "kinds", "distinct").collect()
    for r in found:
        pieces = [r.value.lower()[i : i + 4] for i in range(len(r.value) - 3)]
        assert r.cover == pytest.approx(sum(p in fours for p in pieces) / len(pieces))
        assert r.distinct == pytest.approx(len(set(r.value)) / len(r.value))


def test_random_texts_are_placed_as_by_hand(documents):
    """Values, places and contexts against the pattern run by another engine."""
    rng = random.Random(12)
    signs = ["token", "my_password", "API-KEY/", "a/b+auth", "author", "x" * 15, "y" * 17, "é", " ", "  ", "=", ":", ": ", '"', "'", "`", "&", "&p=", "\n", ".", ")", "Bearer ", "hunter2!", "9f" * 9, "==", "\ufdd0"]
    rows = [(k, "".join(rng.choice(signs) for _ in range(rng.randint(1, 40)))) for k in range(600)]
    pattern = re.compile(S.CANDIDATE.replace("\\z", "\\Z"))
    want = []
    for k, text in rows:
        text = text.replace("\ufdd0", "\ufffd")
        for m in pattern.finditer(text):
            name, held, run = (m[g] or "" for g in (1, 2, 3))
            value = run or (held if re.search("[\"'`]$", name) else re.sub(S.CLOSING, "", held))
            start = m.start() + len(name)
            follow = re.search(pattern, text[m.end() :])
            until = len(text) if follow is None else next((n.start() for n in pattern.finditer(text) if n.start() >= m.end()), len(text))
            if value:
                want.append((k, start, start + len(value), value, text[max(0, start - S.CONTEXT) : start], text[start + len(value) : until][: S.CONTEXT]))
    got = [tuple(r)[:6] for r in S.candidates(documents(rows)).collect()]
    assert len(want) > 500 and sorted(got) == sorted(want)


def test_transitions_against_brute_force(docs):
    from math import log

    known = {r.word: r.n for r in S.dictionary(docs).collect()}
    pairs = {}
    for w, n in known.items():
        for p in [w] if len(w) < 2 else [w[i : i + 2] for i in range(len(w) - 1)]:
            pairs[p] = pairs.get(p, 0) + n
    total = sum(pairs.values())
    for r in S.with_features(S.candidates(docs), S.dictionary(docs)).select("value", "transitions").collect():
        own = [r.value.lower()[i : i + 2] for i in range(len(r.value) - 1)]
        assert r.transitions == pytest.approx(sum(log(pairs[p] / (total + 1)) if p in pairs else log(0.5 / (total + 1)) for p in own) / len(own))


def test_very_long_runs_and_texts(documents):
    import time

    rng = random.Random(3)
    run = "".join(rng.choices("abcdefABCDEF0123456789+/", k=1_000_000))
    names = "token_" * 100_000
    many = "".join(f'password = "{rng.getrandbits(64):x}!" and more words between\n' for _ in range(100_000))
    start = time.time()
    found = S.with_features(S.candidates(documents([(1, run), (2, names), (3, many), (4, "secret=" + "a&" * 200_000)])), S.dictionary(documents([(k, "word text") for k in range(3)])))
    rows = found.select("doc_id", "value", "start", "cover").collect()
    assert time.time() - start < 90
    assert [r.value for r in rows if r.doc_id == 1] == [run] and [len(r.value) for r in rows if r.doc_id == 4] == [400_000]
    assert sum(r.doc_id == 3 for r in rows) == 100_000 and all(many[r.start :].startswith(r.value) for r in rows[:50] if r.doc_id == 3)


def test_forest_keeps_secrets_and_drops_words(docs):
    got = S.secret_findings(docs).collect()
    assert got and all(r.is_secret == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    secret = {(r.doc_id, r.start) for r in got if r.is_secret}
    texts = {r.doc_id: r.text for r in docs.collect()}
    planted = {(i, re.search('"', texts[i]).end()) for i in range(0, 300, 4)} | {(None, 8)}
    assert planted <= secret and all(i in (None, 302, 305) or i % 4 == 0 for i, _ in secret)
    score = {r.doc_id: r.score for r in got}
    assert score[305] > max(score[302], score[2])
    digest = {(r.doc_id, r.start): r.value_sha256 for r in got}
    assert digest[None, 8] == hashlib.sha256(b"A9f3kL0qZ7xW2mB5vN8c").hexdigest()


def test_unnamed_secrets_and_hard_negatives(documents):
    import base64

    def shapes(k):
        rng = random.Random(1000 + k)
        pick = lambda n, of="ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789": "".join(rng.choice(of) for _ in range(n))
        hexes = lambda n: pick(n, "0123456789abcdef")
        secret = [f"we used ghp_{pick(36)} once", f"key id AKIA{pick(16, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')} here", f"Authorization: Bearer {pick(40)}", f"x\n{base64.b64encode(rng.randbytes(48)).decode()}\ny", f"API_KEY={hexes(32)}", f"get ?access_token={hexes(40)} ok"]
        other = [f"fixed in commit {hexes(40)} today", f"row {hexes(8)}-{hexes(4)}-{hexes(4)}-{hexes(4)}-{hexes(12)} there", f"at usr/lib/python{k}/index{k}/notes here"]
        return [(1, t) for t in secret] + [(0, t) for t in other]

    made = [x for k in range(20) for x in shapes(k)]
    got = S.secret_findings(documents([(i, body(i)) for i in range(200)] + [(1000 + i, t) for i, (_, t) in enumerate(made)])).collect()
    found = {r.doc_id for r in got if r.is_secret}
    for sort in range(9):
        hits = sum(1000 + i in found for i in range(sort, len(made), 9))
        assert hits >= 18 if sort < 6 else hits <= 2, (sort, hits)


def test_given_findings_decide(docs, llm):
    rows = [("ab12" * 6 + f"{k:04d}", "key: ", "", 0.0) for k in range(40)] + [("prement" * 4 + "ab" * k, "word ", "", 1.0) for k in range(40)]
    findings = llm.createDataFrame(rows, "value string, before string, after string, label double")
    got = {(r.doc_id, r.start): r.is_secret for r in S.secret_findings(docs, findings).collect()}
    assert got[305, 6] is False and got[304, 10] is True


def test_empty_tables(documents):
    assert S.secret_findings(documents([])).count() == 0
    assert {r.score for r in S.secret_findings(documents([(1, "internationalmenting")])).collect()} == {1 / 3}


def test_planted_tokens_of_the_table(llm):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in llm.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t)}
    got = {(r.doc_id, r.start) for r in S.op10_secret_scan(llm, sf_dir).collect() if r.is_secret}
    assert want and want <= got and len(got - want) <= 0.1 * len(want)
