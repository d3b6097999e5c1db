"""Token counts of a unigram vocabulary, without making the tokens.

An Aho-Corasick automaton enumerates all pieces that occur in a text; dynamic programming over the places of the text carries the
best score of the text so far and the number of pieces on the way to it. Ties go, as in the tokenizer, to the piece that begins
first: a candidate replaces the best one only if it is strictly better, and candidates come from the longest to the shortest.
A character that no single-character piece covers may be an unknown piece of its own, ten below the lowest score; unknown pieces
count as their UTF-8 bytes, or without byte fallback a run of them as one.

Where no piece goes on past a word's end, the best ways of the words do not depend on each other, so a task remembers the words
it has seen.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
PENALTY = 10.0
#: Words a task remembers, and their length at most.
REMEMBERED, LONGEST = 500_000, 64


@dataclass
class Unigram:
    """A vocabulary of scored pieces; built once per task from what travels with it."""

    scores: dict[str, float]
    byte_fallback: bool = True
    _seen: dict = field(default_factory=dict)

    def __post_init__(self):
        self.unknown = min(self.scores.values(), default=0.0) - PENALTY
        self.single = {p for p in self.scores if len(p) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if self.scores:
            self.automaton.make_automaton()
        #: Pieces that hold a space mark after another character tie words together, and so do runs of unknown pieces.
        self.apart = self.byte_fallback and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.scores)
        self.line_break = "\n" not in "".join(self.scores)
        self.words = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+$")

    def best(self, text: str) -> tuple[int, float]:
        """Pieces and score of the best way through a normalised text."""
        n = len(text)
        score, count, open_ = [0.0] + [None] * n, [0] * (n + 1), [False] * (n + 1)
        unknown, single, done = self.unknown, self.single, 0

        def settle(upto: int) -> None:
            """Unknown characters are the last candidates for the places after them."""
            for p in range(done + 1, upto + 1):
                c = text[p - 1]
                if c not in single and (score[p] is None or score[p - 1] + unknown > score[p]):
                    score[p] = score[p - 1] + unknown
                    count[p] = count[p - 1] + (len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else not open_[p - 1])
                    open_[p] = True

        for end, (length, gain) in self.automaton.iter(text) if self.scores else ():
            p = end + 1
            if p - 1 > done:
                settle(p - 1)
                done = p - 1
            start = p - length
            if score[p] is None or score[start] + gain > score[p]:
                score[p], count[p] = score[start] + gain, count[start] + 1
        settle(n)
        return count[n], score[n]

    def count(self, text: str | None) -> tuple[int, float]:
        """Pieces and score of a raw text: spaces become marks, one is put in front; an empty text has no pieces."""
        if not text:
            return 0, 0.0
        if not self.apart:
            return self.best(SPACE + text.replace(" ", SPACE))
        breaks, total, seen = 0, 0.0, self._seen
        marked = SPACE + text.replace(" ", SPACE)
        if self.line_break and "\n" in marked:
            # A line break is its own unknown piece, so the ways before and after it are apart as well.
            breaks = marked.count("\n")
            total = breaks * self.unknown
            parts = [w for line in marked.split("\n") for w in self.words.findall(line)]
        else:
            parts = self.words.findall(marked)
        pieces = breaks
        for word in parts:
            found = seen.get(word)
            if found is None:
                found = self.best(word)
                if len(word) <= LONGEST:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen[word] = found
            pieces += found[0]
            total += found[1]
        return pieces, total


def read_vocabulary(path: str = VOCABULARY) -> dict[str, float]:
    """Pieces and scores of a model file; bytes, control and unknown pieces never match a text."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usual = (i for i in range(model.get_piece_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)))
    return {model.id_to_piece(i): model.get_score(i) for i in usual}


def token_counts(docs: DataFrame, scores: dict[str, float], byte_fallback: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, score``.

    Null and empty texts have no tokens. Repeated rows each give a row; other columns are not read; an empty table gives none.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("score", pa.float64())])

    def run(batches):
        model = Unigram(scores, byte_fallback)
        for batch in batches:
            found = [model.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in found], pa.int64()), pa.array([s for _, s in found], pa.float64())], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, score double")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), read_vocabulary())
