"""Language-model scores of a hidden Markov model over the words of whole texts.

States emit classes of words. Each of the most frequent words is a class of its own; all other words share classes by their last
letters, and within such a class a word is as likely as its count says. So the model's tables are bounded, while every word of the
corpus is counted and looked up: the part of a probability that depends on a rare word alone does not depend on the states, and is
joined from the counts by the word.

Baum-Welch: every pass sends the model to all partitions of the encoded learning texts, each partition returns the expected counts of
its texts (scaled forward and backward recursions), the sums are the next model. The score of a text is the exact probability of its
words and its end, by the scaled forward recursion. Texts are worked off side by side, one place at a time; the forward values
of a bounded number of places are held and the others worked out again, so a text may be of any length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.labelled import held_out
from stratalake.llm.tables import stored, table

FOLDS, HELD_OUT = 7, 2
#: States, passes over the corpus, words with a class of their own (and their bytes at most), classes of the others.
STATES, PASSES, FREQUENT, LONGEST, RARE = 8, 6, 32_768, 64, 256
#: Share of staying in a state at the start, tokens that the prior of a state's words and of its next states counts for.
STAY, PRIOR, NEXT = 0.9, 50.0, 1.0
SEED = 13
#: Tokens of texts worked off side by side, of a section, and those at the texts' beginnings whose forward values are held; bytes of
#: text between two parts of a task's word counts.
CHUNK, SECTION, HELD, COUNTED = 1 << 22, 1 << 18, 1 << 20, 1 << 25
#: Texts worked off side by side at most: a place's products stay in the cache, and below the size from which numpy starts threads.
LANES = 4_096
#: Words a task remembers.
REMEMBERED = 500_000
#: Tokens of a partition of texts of about the same length.
PART = 1 << 21
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: The end of a text is counted as the empty word.
END = ""


def words(text: str | None) -> list[bytes]:
    """Words of a whole text in UTF-8, A-Z lowered. ``bytes.split`` parts at space and 09 to 0D only."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def ending(word: bytes, classes: int) -> int:
    """Class of a rare word: its last two bytes."""
    return zlib.crc32(word[-2:]) % classes


@dataclass
class Classes:
    """Class of every word: frequent words by place, then the end, then the shared classes."""

    frequent: dict[bytes, int]
    rare: int

    def __post_init__(self):
        self.end = len(self.frequent)
        self.size = self.end + 1 + self.rare
        self._seen = dict(self.frequent)

    def __getstate__(self):
        return (self.frequent, self.rare)

    def __setstate__(self, state):
        self.frequent, self.rare = state
        self.__post_init__()

    def encode(self, found: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Classes of the words and of the end; and the words that share a class."""
        seen, end, codes, others = self._seen, self.end, [], []
        for word in found:
            code = seen.get(word)
            if code is None:
                code = end + 1 + ending(word, self.rare)
                if len(word) <= LONGEST:
                    if len(seen) >= REMEMBERED:
                        self._seen = seen = dict(self.frequent)
                    seen[word] = code
            codes.append(code)
            if code > end:
                others.append(word)
        codes.append(end)
        return np.array(codes, "<u2"), others


@dataclass
class Lanes:
    """Encoded texts side by side, the longest first: ``codes`` holds the first token of each, then the second of each, and so on."""

    codes: np.ndarray
    active: np.ndarray  # texts that have a token at this place
    starts: np.ndarray  # where the place begins in ``codes``
    order: np.ndarray  # texts in the order of the lanes

    @classmethod
    def of(cls, texts: list[np.ndarray]) -> Lanes:
        lengths = np.array([len(t) for t in texts])
        order = np.argsort(-lengths, kind="stable")
        ascending = lengths[order][::-1]
        active = len(texts) - np.searchsorted(ascending, np.arange(lengths.max()), "right")
        starts = np.concatenate(([0], np.cumsum(active)))
        codes = np.empty(starts[-1], np.int64)
        for lane, k in enumerate(order):
            codes[starts[: lengths[k]] + lane] = texts[k]
        return cls(codes, active, starts, order)

    def sections(self) -> list[tuple[int, int]]:
        """Ranges of places with about ``SECTION`` tokens each, at least one place."""
        cuts, at = [0], 0
        while at < len(self.active):
            at = max(at + 1, int(np.searchsorted(self.starts, self.starts[at] + SECTION, "right")) - 1)
            cuts.append(min(at, len(self.active)))
        return list(zip(cuts, cuts[1:]))


@dataclass
class Model:
    start: np.ndarray  # first state
    move: np.ndarray  # next state, by state
    emit: np.ndarray  # classes, by state: [class, state]

    def forward(self, lanes: Lanes, first: int, last: int, before: np.ndarray | None):
        """Emissions, scaled forward values and scales of the places from ``first`` up to ``last``."""
        base = lanes.starts[first]
        emitted = np.take(self.emit, lanes.codes[base : lanes.starts[last]], axis=0)
        values, scales, ones = np.empty_like(emitted), np.empty(len(emitted)), np.ones(len(self.start))
        a = b = 0
        for n in lanes.active[first:last].tolist():
            b = a + n
            now, scale = values[a:b], scales[a:b]
            if before is None:
                np.multiply(emitted[a:b], self.start, out=now)
            else:
                np.matmul(before[:n], self.move, out=now)
                now *= emitted[a:b]
            np.matmul(now, ones, out=scale)  # sums of short rows
            now /= scale[:, None]
            before, a = now, b
        return emitted, values, scales, before

    def log_probability(self, lanes: Lanes) -> np.ndarray:
        """Natural logarithm of each text's probability, in the order of the texts."""
        total, before = np.zeros(len(lanes.order)), None
        for first, last in lanes.sections():
            _, _, scales, before = self.forward(lanes, first, last, before)
            lane = np.arange(len(scales)) - np.repeat(lanes.starts[first:last] - lanes.starts[first], lanes.active[first:last])
            total += np.bincount(lane, np.log(scales), len(total))
        out = np.empty(len(total))
        out[lanes.order] = total
        return out

    def expected(self, lanes: Lanes) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected first states, moves and emissions of the texts, and their log-probability."""
        sections, parts, before = lanes.sections(), [], None
        for first, last in sections:
            border = before
            _, values, scales, before = self.forward(lanes, first, last, border)
            if lanes.starts[last] > HELD:  # worked out again on the way back
                values = scales = None
                before = before.copy()
            parts.append((first, last, border, values, scales))
        moved, emitted_sum, later, total = np.zeros_like(self.move), np.zeros_like(self.emit), None, 0.0
        while parts:
            first, last, border, values, scales = parts.pop()
            if values is None:
                emitted, values, scales, _ = self.forward(lanes, first, last, border)
            else:
                emitted = np.take(self.emit, lanes.codes[lanes.starts[first] : lanes.starts[last]], axis=0)
            total += np.log(scales).sum()
            ratio = emitted / scales[:, None]
            backward = np.ones_like(values)
            b = len(values)
            for n in lanes.active[first:last][::-1].tolist():
                a = b - n
                if later is not None:
                    m = len(later)
                    np.matmul(later, self.move.T, out=backward[a : a + m])
                    moved += values[a : a + m].T @ later
                later = ratio[a:b] * backward[a:b]
                b = a
            values *= backward
            codes = lanes.codes[lanes.starts[first] : lanes.starts[last]]
            for k, of_state in enumerate(np.ascontiguousarray(values.T)):
                emitted_sum[:, k] += np.bincount(codes, of_state, len(emitted_sum))
        return values[: lanes.active[0]].sum(axis=0), moved * self.move, emitted_sum, total

    @classmethod
    def guess(cls, share: np.ndarray, states: int) -> Model:
        """States that stay, each with its own disturbed word frequencies."""
        emit = share[:, None] * np.exp(np.random.default_rng(SEED).normal(size=(len(share), states)))
        move = np.full((states, states), (1 - STAY) / max(1, states - 1))
        np.fill_diagonal(move, STAY if states > 1 else 1.0)
        return cls(np.full(states, 1 / states), move, emit / emit.sum(axis=0))

    @classmethod
    def of_counts(cls, first: np.ndarray, moved: np.ndarray, emitted: np.ndarray, share: np.ndarray) -> Model:
        """The most likely model given expected counts and the priors."""
        k = len(first)
        move = moved + NEXT / k
        emit = emitted + PRIOR * share[:, None]
        return cls((first + 1 / k) / (first.sum() + 1), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def _chunks(batches, column: int):
    """Rows of several batches and their decoded texts, about ``CHUNK`` tokens at a time."""
    rows, texts, held = [], [], 0
    for batch in batches:
        rows.append(batch)
        found = [np.frombuffer(c.as_py(), "<u2") for c in batch.column(column)]
        texts += found
        held += sum(map(len, found))
        if held >= CHUNK:
            yield pa.Table.from_batches(rows), texts
            rows, texts, held = [], [], 0
    if texts:
        yield pa.Table.from_batches(rows), texts


def _side_by_side(texts: list[np.ndarray]):
    """Places of up to ``LANES`` texts of about the same length, and their lanes."""
    order = np.argsort([-len(t) for t in texts], kind="stable")
    for at in range(0, len(order), LANES):
        some = order[at : at + LANES]
        yield some, Lanes.of([texts[k] for k in some])


def word_counts(docs: DataFrame, rare: int = RARE, text: str = "text") -> DataFrame:
    """``(word, class, n)`` of all words and of the end (the empty word); counted in the tasks before the shuffle."""
    schema = pa.schema([("word", pa.string()), ("class", pa.int32()), ("n", pa.int64())])

    def part(counts):
        found = list(counts.items())
        for at in range(0, len(found), 50_000):
            some = found[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.binary()).cast(pa.string()), pa.array([ending(w, rare) for w, _ in some], pa.int32()), pa.array([n for _, n in some], pa.int64())], schema=schema)

    def run(batches):
        counts, size = Counter(), 0
        for batch in batches:
            for body in batch.column(0):
                body = body.as_py()
                counts.update(words(body))
                counts[b""] += 1
                size += len(body or "")
                if size >= COUNTED:
                    yield from part(counts)
                    counts, size = Counter(), 0
        yield from part(counts)

    return docs.select(text).mapInArrow(run, "word string, class int, n long").groupBy("word", "class").agg(F.sum("n").alias("n"))


@dataclass
class Counts:
    """What was counted in the learning texts: the table of all words, and for each class what scoring needs of it."""

    table: DataFrame  # word, n of the words that share classes
    classes: Classes
    tokens: int
    types: int
    share: np.ndarray  # of the tokens, by class
    known: np.ndarray  # 1 for classes of one word that occurs
    log_count: np.ndarray  # log10(n + 1) of classes of one word, 0 for shared ones
    log_members: np.ndarray  # log10 of a shared class's tokens, types and one


def count(docs: DataFrame, frequent: int = FREQUENT, rare: int = RARE, text: str = "text") -> Counts:
    """Count the words of ``docs``; at most ``frequent`` words of at most ``LONGEST`` bytes get classes of their own."""
    counted = stored(word_counts(docs, rare, text), "words")
    tokens, types, ends = counted.agg(F.sum("n"), F.count("*"), F.max(F.when(F.col("word") == END, F.col("n")))).first()
    own = counted.filter((F.col("word") != END) & (F.octet_length("word") <= LONGEST)).orderBy(F.desc("n"), "word").limit(frequent).select("word", "n").toPandas()
    classes = Classes({w.encode(): k for k, w in enumerate(own["word"])}, rare)
    least = int(own["n"].min()) if len(own) else 0
    shared = counted.filter((F.col("word") != END) & ((F.col("n") <= least) | (F.octet_length("word") > LONGEST)))
    mass = np.zeros((rare, 2))
    for row in shared.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("types")).toPandas().itertuples():
        mass[row[1]] = row.n, row.types
    # Frequent words that are as rare as the last of them were just counted as shared ones.
    for word, n in zip(own["word"], own["n"]):
        if n <= least:
            mass[ending(word.encode(), rare)] -= n, 1
    single = np.concatenate([own["n"].to_numpy(float), [ends or 0]])
    share = np.concatenate([single, mass[:, 0]]) + 1
    nothing = np.zeros(rare)
    return Counts(
        shared.select("word", "n"), classes, tokens or 0, types, share / share.sum(), np.concatenate([single > 0, nothing]).astype(np.int64),
        np.concatenate([np.log10(single + 1), nothing]), np.concatenate([np.zeros(len(single)), np.log10(mass.sum(axis=1) + 1)]),
    )


def encoded(docs: DataFrame, classes: Classes, doc_id: str, text: str, held: Column) -> DataFrame:
    """``key, doc_id, held_out, codes, others``: classes of the words, and the words that share classes with their numbers."""
    narrow = docs.select(F.monotonically_increasing_id().alias("key"), F.col(doc_id).alias("doc_id"), held.alias("held_out"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            codes, rest, times, ends = [], [], [], [0]
            for body in batch.column(3):
                found, shared = classes.encode(words(body.as_py()))
                codes.append(found.tobytes())
                counted = Counter(shared)
                rest.extend(counted)
                times.extend(counted.values())
                ends.append(len(rest))
            pairs = pa.StructArray.from_arrays([pa.array(rest, pa.binary()).cast(pa.string()), pa.array(times, pa.int64())], ["word", "n"])
            others = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(codes, pa.binary()), others], names=["key", "doc_id", "held_out", "codes", "others"])

    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.mapInArrow(run, f"key long, doc_id {kind}, held_out boolean, codes binary, others array<struct<word:string,n:long>>")


def by_length(texts: DataFrame, tokens: int = PART) -> DataFrame:
    """The same rows, those of about the same length in the same partitions of about ``tokens`` tokens.

    A task works off its texts side by side, so it takes as many steps as its longest text has places; apart from the others, long
    texts do not hold up short ones.
    """
    size = F.octet_length("codes") / 2
    sized = texts.withColumn("size", size).withColumn("level", F.floor(F.log2("size")))
    parts = sized.groupBy("level").agg(F.ceil(F.sum("size") / tokens).alias("parts"))
    total = parts.agg(F.sum("parts")).first()[0] or 1
    dealt = sized.join(parts, "level").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
    return dealt.repartition(int(total), "level", "part").select(*texts.columns)


def train(learning: DataFrame, share: np.ndarray, states: int = STATES, passes: int = PASSES) -> tuple[Model, list[float]]:
    """Baum-Welch over a column ``codes``: the model, and the log-probability before each pass.

    Each partition returns its expected counts, one row for each class, state and the start, which are summed by a shuffle; the
    driver sees these sums only.
    """
    model, history = Model.guess(share, states), []
    names = [f"s{k}" for k in range(states)]
    schema = pa.schema([("row", pa.int32())] + [(n, pa.float64()) for n in names])

    def counting(model):
        def run(batches):
            first, moved, emitted, total = np.zeros(states), np.zeros((states, states)), np.zeros_like(model.emit), 0.0
            for _, texts in _chunks(batches, 0):
                for _, lanes in _side_by_side(texts):
                    for whole, some in zip((first, moved, emitted), found := model.expected(lanes)):
                        whole += some
                    total += found[3]
            if not first.any():
                return
            # Rows below zero: the log-probability, the first states, the moves from each state.
            sums = np.vstack([np.full(states, total), first, moved, emitted])
            places = np.concatenate([np.arange(-2 - states, 0), np.arange(len(emitted))])
            used = sums.any(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(places[used], pa.int32()), *(pa.array(c) for c in sums[used].T)], schema=schema)

        return run

    for _ in range(passes):
        sums = learning.select("codes").mapInArrow(counting(model), ", ".join(["row int", *(f"{n} double" for n in names)]))
        found = sums.groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
        if not len(found):
            break
        whole = np.zeros((2 + states + len(share), states))
        whole[found["row"].to_numpy() + 2 + states] = found[names].to_numpy()
        history.append(float(whole[0, 0]))
        model = Model.of_counts(whole[1], whole[2 : 2 + states], whole[2 + states :], share)
    return model, history


def scored(texts: DataFrame, others: DataFrame, counts: Counts, model: Model) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for encoded texts; ``others``: their key and other words."""
    kind = texts.schema["doc_id"].dataType.simpleString()
    known, log_count, log_members = counts.known, counts.log_count, counts.log_members

    def run(batches):
        for rows, found in _chunks(batches, 3):
            log10 = np.empty(len(found))
            for some, lanes in _side_by_side(found):
                log10[some] = model.log_probability(lanes) / np.log(10)
            log10 -= [log_members[c].sum() for c in found]
            columns = [pa.array([len(c) for c in found], pa.int64()), pa.array([int(known[c].sum()) for c in found], pa.int64()), pa.array([log_count[c].sum() for c in found]), pa.array(log10)]
            table_ = rows.drop_columns(["codes"])
            for name, column in zip(("n_tokens", "n_known", "counted", "score"), columns):
                table_ = table_.append_column(name, column)
            yield from table_.combine_chunks().to_batches()

    of_states = texts.select("key", "doc_id", "held_out", "codes").mapInArrow(run, f"key long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, counted double, score double")
    words_of = others.select("key", F.inline("others")).withColumnRenamed("n", "times")
    looked_up = words_of.join(counts.table, "word", "left").groupBy("key").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"), F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1)).alias("more_counted")
    )
    more = F.coalesce("more_counted", F.lit(0.0))
    return of_states.join(looked_up, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
        (F.col("counted") + more - F.col("n_tokens") * float(np.log10(counts.tokens + counts.types + 1))).alias("base_score"), (F.col("score") + more).alias("score"),
    )


def language_model_scores(
    docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text", states: int = STATES, passes: int = PASSES, frequent: int = FREQUENT, rare: int = RARE,
) -> DataFrame:
    """Score all rows by a model learned from those that are not ``held`` out; a row for each row.

    ``score`` is the model's log10 probability of the words and the end, ``base_score`` that of the words' own smoothed
    frequencies. Words that no learning text holds count as one unknown word of each class. Null and empty texts have an end only.
    Texts may be of any length and words too; words of more than ``LONGEST`` bytes share classes. Ties among the most frequent
    words go by code point. A repeated row counts and is scored each time; without learning texts all classes are alike.
    Other columns are not read.
    """
    if frequent + rare + 1 > 1 << 16 or rare < 1 or states < 1:
        raise ValueError("frequent and shared classes together are at most 65,535, with one shared class and one state at least")
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    held = F.coalesce(held, F.lit(False))
    counts = count(docs.filter(~held).select(F.col(text).alias("text")), frequent, rare)
    texts = stored(encoded(chosen, counts.classes, "doc_id", "text", held), "encoded")
    dealt = stored(by_length(texts.select("key", "doc_id", "held_out", "codes")), "dealt")
    model, _ = train(dealt.filter("not held_out"), counts.share, states, passes)
    return scored(dealt, texts.select("key", "others"), counts, model)


def op13_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_model_scores(docs, held_out(F.col("doc_id"), FOLDS, HELD_OUT))
