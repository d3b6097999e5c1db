import random

import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.models import Unigram as Reference

from stratalake.llm import token_counts as T


@pytest.fixture(scope="module")
def scores():
    return T.read_vocabulary()


@pytest.fixture(scope="module")
def reference(scores):
    """Another library's tokenizer over the same pieces and scores."""
    model = sentencepiece.SentencePieceProcessor(model_file=T.VOCABULARY)
    bytes_ = [(model.id_to_piece(i), 0.0) for i in range(model.get_piece_size()) if model.is_byte(i)]
    made = Tokenizer(Reference([("<unk>", 0.0), *bytes_, *scores.items()], 0, True))
    return lambda text: len(made.encode(T.SPACE + text.replace(" ", T.SPACE), add_special_tokens=False).ids) if text else 0


TEXTS = ["", "a", " ", "  two  spaces ", "one\ntwo\n\n three", "été ça \U0001F600一鿿", "tab\tand\x00nul", "x" * 5000, "word " * 3000, "▁ mark", "\n", " \n "]


@pytest.mark.parametrize("text", TEXTS)
def test_counts_are_those_of_the_tokenizer(scores, reference, text):
    assert T.Unigram(scores).count(text)[0] == reference(text)


def brute(text, scores, byte_fallback):
    """All places from left to right, starts in order; as the tokenizer is defined."""
    low = min(scores.values()) - T.PENALTY
    best = {0: (0.0, ())}
    for i in range(len(text)):
        for j in range(i + 1, len(text) + 1):
            piece = text[i:j]
            gain = scores.get(piece, low if j == i + 1 else None)
            if gain is not None and (j not in best or best[i][0] + gain > best[j][0]):
                best[j] = (best[i][0] + gain, (*best[i][1], piece if piece in scores else None if not byte_fallback else piece.encode()))
    score, way = best[len(text)]
    if byte_fallback:
        return sum(len(p) if isinstance(p, bytes) else 1 for p in way), score
    return sum(1 for k, p in enumerate(way) if p is not None or k == 0 or way[k - 1] is not None), score


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("across", [False, True])
def test_ties_unknowns_and_pieces_across_words(byte_fallback, across):
    rng = random.Random(across)
    for _ in range(150):
        letters = "ab" + T.SPACE
        pieces = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 4))): float(-rng.randint(0, 3)) for _ in range(8)}
        if not across:
            pieces = {p.lstrip(T.SPACE).replace(T.SPACE, "a") or T.SPACE: s for p, s in pieces.items()} | {T.SPACE + "a": -1.0}
        text = "".join(rng.choice("abé \n") for _ in range(rng.randint(1, 14)))
        assert T.Unigram(pieces, byte_fallback).count(text) == brute(T.SPACE + text.replace(" ", T.SPACE), pieces, byte_fallback)


def test_memory_is_bounded(scores, monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 3)
    model = T.Unigram(scores)
    assert model.count("a b c d e f g a b c")[0] == T.Unigram(scores).count("a b c d e f g a b c")[0] and len(model._seen) <= 3


def test_rows(documents, scores, rows, reference):
    docs = [(1, None), (2, ""), (None, "hello world"), (4, "hello world"), (4, "hello world"), (5, "long text " * 20000)]
    assert rows(T.token_counts(documents(docs), scores).drop("score")) == sorted(((i, reference(t or "")) for i, t in docs), key=str)
    assert T.token_counts(documents([]), scores).count() == 0
    assert rows(T.token_counts(documents(docs[:4]), {}).drop("score")) == sorted([(1, 0), (2, 0), (None, 16), (4, 16)], key=str)


def test_query_against_the_tokenizer(llm, sf_dir, rows, reference):
    docs = llm.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert rows(T.op2_token_counts(llm, sf_dir).drop("score")) == sorted(((r.doc_id, reference(r.text)) for r in docs), key=str)
