"""Spelling variants: words one inserted, deleted or replaced character apart, found by search schemes on FM-indexes.

Two words that differ by one character agree in one half. So each word is searched twice: its right half is matched exactly and the
match is extended to the left over the other half, one error allowed; then the same from the left half to the right, which is the
same search on an index of the reversed words (with two halves no search changes its direction, so each direction has its own
index). The index is that of the delimited vocabulary ``$abc$abd$``: an interval of suffix ranks stands for all words that go on
alike, a backward step maps both its ends, and the rank of a whole word's delimiter is the word.

The vocabulary is dealt out by the exact half: a word goes as a query to the place of its own half, and as an indexed word to the
places of the halves that words of its own length, one shorter and one longer would share with it. A half that very many
words share is cut into blocks, and its queries visit each block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import ascii_lower, free_name, stored, table

#: Fixed values of the query: letters, every how many runs lose a letter, shortest word, least count, weight of a form.
LETTERS = r"A-Za-zÀ-ÿ"
LOSS = 31
SHORTEST, LEAST, TIMES = 7, 2, 10
#: Indexed words in a task on average, and at most for one half; queries searched at once.
SHARD, CELL, QUERIES = 50_000, 50_000, 20_000
#: Intervals up to this width are extended row by row, wider ones symbol by symbol.
NARROW = 64
#: Doublings of the way to the root. Counts grow at least ``times``-fold along it, so no way has 64 steps.
DOUBLINGS = 6


class Index:
    """FM-index of words in ascending order, each a row of symbols from 1 on; 0 is the delimiter."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        order = suffix_order(text)
        last = text[order - 1]
        self.size, self.last = n, last
        by_symbol = np.argsort(last, kind="stable")
        #: Sorted (symbol, rank) pairs: a pair's place is the rank that the backward step maps it to.
        self.steps = last[by_symbol].astype(np.int64) * (n + 1) + by_symbol
        self.mapped = np.empty(n, np.int64)
        self.mapped[by_symbol] = np.arange(n)
        self.symbols = np.unique(text[text > 0])

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Interval of the match with ``symbol`` in front of it."""
        base = symbol.astype(np.int64) * (self.size + 1)
        return np.searchsorted(self.steps, base + low), np.searchsorted(self.steps, base + high)

    def children(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
        """All ways to extend the intervals by a letter: ``(interval, symbol, low, high)``."""
        width = high - low
        narrow, wide = np.flatnonzero(width <= NARROW), np.flatnonzero(width > NARROW)
        of = np.repeat(narrow, width[narrow])
        rows = np.arange(len(of)) - np.repeat(np.cumsum(width[narrow]) - width[narrow], width[narrow]) + low[of]
        symbol = self.last[rows]
        keep = symbol > 0
        of, rows, symbol = of[keep], rows[keep], symbol[keep]
        key = of * (int(self.symbols.max(initial=0)) + 1) + symbol
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        final = np.append(first[1:], len(order)) - 1
        ends = [of[order[first]], symbol[order[first]], self.mapped[rows[order[first]]], self.mapped[rows[order[final]]] + 1] if len(order) else [np.empty(0, np.int64)] * 4
        if len(wide):
            of, symbol = np.repeat(wide, len(self.symbols)), np.tile(self.symbols, len(wide))
            a, b = self.step(symbol, low[of], high[of])
            keep = a < b
            ends = [np.concatenate(pair) for pair in zip(ends, (of[keep], symbol[keep], a[keep], b[keep]))]
        return tuple(ends)

    def one_error(self, words: np.ndarray, exact: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs ``(query, word)`` of words one error apart that end in the query's last ``exact`` symbols.

        ``words`` are queries of one length, a row of symbols each; ``own`` is 1 where the query itself is indexed. A query
        is left as soon as nothing but itself matches.
        """
        count, length = words.shape
        query = np.arange(count)
        low, high = np.zeros(count, np.int64), np.full(count, self.size)
        symbol = np.zeros(count, np.int64)  # the delimiter after the word
        for done in range(exact + 1):
            low, high = self.step(symbol, low, high)
            keep = high - low > own[query]
            query, low, high = query[keep], low[keep], high[keep]
            if not len(query):
                return query, query
            if done < exact:
                symbol = words[query, length - 1 - done]
        wrong = [np.empty(0, np.int64)] * 3  # query, low, high after one error
        for done in range(exact, length + 1):
            of, symbol, a, b = self.children(low, high)
            added = [[query[of], a, b]]  # a letter more in the word found
            if done < length:
                expected = words[:, length - 1 - done]
                merged = self._distinct([np.concatenate(x) for x in zip(wrong, *added)])
                a2, b2 = self.step(expected[merged[0]], merged[1], merged[2])
                keep = a2 < b2
                other = symbol != expected[query[of]]
                after = [[merged[0][keep], a2[keep], b2[keep]], [query[of][other], a[other], b[other]], [query, low, high]]
                wrong = [np.concatenate(x) for x in zip(*after)]
                low, high = self.step(expected[query], low, high)
                keep = high - low > own[query]
                query, low, high = query[keep], low[keep], high[keep]
            else:
                wrong = [np.concatenate(x) for x in zip(wrong, *added)]
        a, b = self.step(np.zeros(len(wrong[0]), np.int64), wrong[1], wrong[2])
        keep = a < b
        # Rank 0 is the closing delimiter, rank k + 1 the delimiter before word k.
        pairs = np.unique(wrong[0][keep] * (self.size + 1) + a[keep] - 1)
        return pairs // (self.size + 1), pairs % (self.size + 1)

    def _distinct(self, state: list[np.ndarray]) -> list[np.ndarray]:
        """The same interval of a query is reached in several ways where a letter is doubled."""
        query, low, high = state
        order = np.lexsort((high, low, query))
        query, low, high = query[order], low[order], high[order]
        new = np.ones(len(query), bool)
        new[1:] = (query[1:] != query[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        return [query[new], low[new], high[new]]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffixes in ascending order, by doubling the compared length; the first four symbols are compared at once."""
    n, width = len(text), 4
    key, padded = np.zeros(n, np.uint64), np.concatenate([text.astype(np.uint64), np.zeros(width, np.uint64)])
    for k in range(width):
        key = (key << np.uint64(16)) | padded[k : k + n]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.ones(n, bool)
        new[1:] = key[order[1:]] != key[order[:-1]]
        if new.all():
            return order
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new)
        following = np.zeros(n, np.uint64)
        following[: max(0, n - width)] = rank[width:]
        key = rank * np.uint64(n + 1) + following
        width *= 2


def near_words(indexed: list[str], queries: list[str], left: bool) -> list[tuple[str, str]]:
    """Pairs ``(query, word)`` of words one error apart: with the right half alike, or the left half and not the right one.

    For the left half, both lists hold reversed words. They may hold up to 55,000 different letters.
    """
    indexed = sorted(set(indexed))
    letters = sorted(set("".join(indexed)).union(*queries)) if queries else []
    if not indexed or not letters:
        return []
    code = {ord(c): k for k, c in enumerate(letters, 1)}
    symbols = lambda words: np.frombuffer("".join(words).translate(code).encode("utf-16-le"), np.uint16)
    index = Index(symbols(["\0" + "\0".join(indexed) + "\0"]))
    known, by_length, out = set(indexed), {}, []
    for word in queries:
        by_length.setdefault(len(word), []).append(word)
    for length, words in by_length.items():
        exact = length // 2 if left else length - length // 2
        for at in range(0, len(words), max(1, QUERIES * 16 // max(16, length))):
            part = words[at : at + max(1, QUERIES * 16 // max(16, length))]
            own = np.array([w in known for w in part], np.int64)
            found = index.one_error(symbols(part).reshape(len(part), length), exact, own)
            pairs = ((part[q], indexed[k]) for q, k in zip(*(x.tolist() for x in found)))
            if left:
                head = length - length // 2
                pairs = ((q[::-1], w[::-1]) for q, w in pairs if q[:head] != w[:head])
            out.extend(pairs)
    return out


def _search(batches):
    """Pairs of a task's words. Blocks of a full half have an index each, the words of all other halves one for each side."""
    words: dict[str, int] = {}
    groups: dict[tuple, tuple[list, list]] = {}
    for batch in batches:
        for side, group, word, n, is_indexed, is_query in zip(*(c.to_pylist() for c in batch.columns)):
            words[word] = n
            indexed, queries = groups.setdefault((side, group), ([], []))
            text = word[::-1] if side else word
            if is_indexed:
                indexed.append(text)
            if is_query:
                queries.append(text)
    schema = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])
    for (side, _), (indexed, queries) in groups.items():
        pairs = near_words(indexed, queries, side)
        for at in range(0, len(pairs), 50_000):
            part = pairs[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array([q for q, _ in part]), pa.array([w for _, w in part]), pa.array([words[w] for _, w in part], pa.int64())], schema=schema)


def near_pairs(vocabulary: DataFrame, cell: int = CELL, shard: int = SHARD) -> DataFrame:
    """``(word, near, near_n)`` for all words of the table ``(word, n)`` that differ by exactly one character; each pair both ways.

    Words are distinct, not null and hold at least two characters.
    """
    length = F.length("word")
    sides = F.explode(F.array(F.lit(False), F.lit(True))).alias("side")
    spread = vocabulary.select("word", "n", sides).select("*", F.explode(F.sequence(F.greatest(F.lit(2), length - 1), length + 1)).alias("m"))
    exact = F.when(F.col("side"), F.floor(F.col("m") / 2)).otherwise(F.ceil(F.col("m") / 2)).cast("int")
    half = F.when(F.col("side"), F.substring(F.col("word"), F.lit(1), exact)).otherwise(F.substring(F.col("word"), length - exact + 1, exact))
    rows = spread.select("side", "word", "n", F.xxhash64("side", "m", half).alias("half"), (F.col("m") == length).alias("query"))
    total = vocabulary.count()
    full = rows.groupBy("half").agg(F.count("*").alias("members")).filter(F.col("members") > cell)
    blocks = full.select("half", F.ceil(F.col("members") / cell).cast("int").alias("blocks"))
    dealt = rows.join(blocks, "half", "left").withColumn("own", F.pmod(F.xxhash64("word"), F.coalesce("blocks", F.lit(1))).cast("int"))
    every = F.when(F.col("query") & F.col("blocks").isNotNull(), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))
    dealt = dealt.withColumn("block", F.explode(every)).withColumn("indexed", F.col("block") == F.col("own"))
    parts = max(1, math.ceil(6 * total / shard))
    group = F.when(F.col("blocks").isNotNull(), F.xxhash64("half", "block")).otherwise(F.lit(0)).alias("group")
    placed = dealt.repartition(parts, "half", "block").select("side", group, "word", "n", "indexed", "query")
    return placed.mapInArrow(_search, "word string, near string, near_n long")


def variant_groups(vocabulary: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for a table of distinct words and their counts.

    ``n_near`` words differ from the word by one character. The most frequent of them (ties: the smallest in code-point order) is
    its ``form`` if it is at least ``times`` (2 or more) as frequent; ``root`` is the last of the forms' forms, the word itself if it has none.
    An empty table gives no rows.
    """
    if times < 2:
        raise ValueError("times is at least 2, so that no form leads back to its word")
    vocabulary = stored(vocabulary.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    near = stored(near_pairs(vocabulary).groupBy("word").agg(F.count("*").alias("n_near"), best), "near")
    joined = vocabulary.join(near, "word", "left").withColumn("top", -F.col("best.less"))
    has = F.col("top") >= times * F.col("n")
    formed = stored(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.form")).alias("form"), F.when(has, F.col("top")).alias("form_n")), "forms")
    way = formed.filter("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        way = stored(way.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "roots")
    return formed.join(way, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def vocabulary(docs: DataFrame, edited: Column | None = None, shortest: int = SHORTEST, least: int = LEAST, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(word, n)``: runs of letters, A-Z lowered, of at least ``shortest`` characters that occur ``least`` times or more.

    ``edited`` turns the columns ``id`` and ``run`` into the word; without it the run is the word. Null texts have no words; a null
    id counts as empty; repeated rows count each; other columns are not read.
    """
    runs = F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    words = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    words = words.select("id", ascii_lower(F.col("run")).alias("run"))
    words = words.select((F.col("run") if edited is None else edited).alias("word")).filter(F.length("word") >= shortest)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def with_lost_letters(every: int = LOSS) -> Column:
    """The run, without one letter where ``every`` divides the hash of id and run."""
    hashed = F.crc32(F.concat_ws(":", "id", "run"))
    place = (hashed % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.length("run")))
    return F.when(hashed % every == 0, shorter).otherwise(F.col("run"))


def with_root_form(docs: DataFrame, groups: DataFrame, wish: str = "corrected", text: str = "text") -> DataFrame:
    """All columns and the text in which every word that has a root other than itself is replaced by it.

    Texts are cut at words, joined to the roots by word, and put together again by row: a group is one text. Null texts stay null.
    """
    name, key = free_name(docs, wish), free_name(docs, "row_key")
    rows = stored(docs.withColumn(key, F.monotonically_increasing_id()), "texts")
    roots = groups.filter("root <> word").select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    pieces = rows.select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]+|[^{LETTERS}]+"), F.lit(0))).alias("_at", "_piece"))
    worded = pieces.withColumn("_word", F.when(F.col("_piece").rlike(f"^[{LETTERS}]"), ascii_lower(F.col("_piece"))))
    placed = F.struct("_at", F.coalesce("_root", "_piece").alias("piece"))
    put = worded.join(roots, "_word", "left").groupBy(key).agg(F.array_sort(F.collect_list(placed)).alias("_placed"))
    return rows.join(put, key, "left").select(*docs.columns, F.coalesce(F.array_join("_placed.piece", ""), F.col(text)).alias(name))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_groups(vocabulary(table(spark, sf_dir, "documents"), with_lost_letters()))
