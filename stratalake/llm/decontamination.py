"""Benchmark decontamination: word windows of the corpus looked up in a hash set of the benchmark's windows.

The benchmark's windows are normalised word sequences. They are the only thing that is broadcast, after a check of their
measured size; a larger benchmark is joined by shuffling the same rows. Windows are joined as text, so that equal hashes of
different windows can't count as a hit. Everything is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import ascii_lower, free_name, stored, table

WINDOW = 10
#: Bytes of window texts and item ids up to which the benchmark is broadcast.
BROADCAST_BYTES = 32 << 20
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same words in a text whose letters keep their case.
CASED_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), BREAKS), "")


def windows(found: Column, length: int) -> Column:
    """Structs ``(at, length, window)`` for each place where a window of the length begins."""
    count = F.size(found) - length + 1
    place = lambda i: F.struct(i.alias("at"), F.lit(length).alias("length"), F.array_join(F.slice(found, i, length), " ").alias("window"))
    return F.transform(F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>")), place)


def benchmark_windows(benchmark: DataFrame, length: int = WINDOW) -> DataFrame:
    """``(window, length, items)``: every distinct window with the ids, as strings, of the items that hold it.

    An item of fewer words is one window; an item without words has none. Items without an id count under the empty id.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words(F.col("text")).alias("w"))
    short = F.transform(F.array(F.array_join("w", " ")), lambda x: F.struct(F.lit(1).alias("at"), F.size("w").alias("length"), x.alias("window")))
    every = F.when(F.size("w") < length, short).otherwise(windows(F.col("w"), length))
    rows = items.filter(F.size("w") > 0).select("item", F.explode(every).alias("e"))
    return rows.groupBy(F.col("e.window").alias("window"), F.col("e.length").alias("length")).agg(F.sort_array(F.collect_set("item")).alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, keys: list[str], text: str = "text", length: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """For each combination of ``keys``: ``n_words``, ``places`` (the hit words' numbers, from 1) and sorted ``items``.

    ``keys`` must not join rows of different texts. Every row gives a row, also without words.
    """
    known = stored(benchmark_windows(benchmark, length), "windows")
    size, lengths = known.agg(F.sum(F.octet_length("window") + F.octet_length(F.array_join("items", ",")) + 64), F.collect_set("length")).first()
    spread = docs.select(*keys, words(F.col(text)).alias("w"))
    # One row of each document stays without a hit; its window is one that no text has and that differs by document.
    alone = F.array(F.struct(F.lit(0).alias("at"), F.lit(0).alias("length"), F.concat_ws("-", F.lit(""), F.xxhash64(*keys).cast("string")).alias("window")))
    every = F.concat(alone, *[windows(F.col("w"), n) for n in sorted(lengths)])
    spread = spread.select(*keys, F.size("w").cast("long").alias("n_words"), F.explode(every).alias("e")).select(*keys, "n_words", "e.*")
    known = known.select("window", "items")
    found = spread.join(F.broadcast(known) if (size or 0) <= broadcast_bytes else known, "window", "left").filter("at = 0 or items is not null")
    covered = F.when(F.col("at") > 0, F.sequence(F.col("at"), F.col("at") + F.col("length") - 1)).otherwise(F.array().cast("array<int>"))
    grouped = found.groupBy(*keys, "n_words").agg(F.collect_list(covered).alias("places"), F.collect_set("items").alias("items"))
    return grouped.select(*keys, "n_words", F.array_distinct(F.flatten("places")).alias("places"), F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null and empty texts have no words. Repeated rows each give a row. An empty benchmark hits nothing.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    found = hits(narrow, benchmark, ["row", "doc_id"], length=length)
    n_hit = F.size("places").cast("long")
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def _hit_texts(docs: DataFrame, benchmark: DataFrame, text: str, key: str, length: int) -> tuple[DataFrame, DataFrame]:
    """The documents with their text's digest as ``key``, and the digests of the texts that are hit."""
    marked = docs.withColumn(key, F.sha2(F.col(text), 256))
    found = hits(marked.filter(F.col(text).isNotNull()), benchmark, [key], text, length)
    return marked, stored(found.filter(F.size("places") > 0), "hits")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: int = WINDOW) -> DataFrame:
    """The documents that no window of the benchmark hits, all columns as they are."""
    key = free_name(docs, "digest")
    marked, found = _hit_texts(docs, benchmark, text, key, length)
    # Hits grow with the corpus: they are dealt out with the texts at every size, without sorting the texts.
    return marked.join(found.select(key).hint("shuffle_hash"), key, "left_anti").select(*docs.columns)


def without_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: int = WINDOW) -> DataFrame:
    """All documents; hit words are cut out of their texts together with the breaks before them."""
    key, places = free_name(docs, "digest"), free_name(docs, "places")
    marked, found = _hit_texts(docs, benchmark, text, key, length)
    joined = marked.join(found.select(key, F.col("places").alias(places)).hint("shuffle_hash"), key, "left")
    # Words and the breaks before them are paired first: an expression inside a lambda is evaluated for each element.
    whole, gaps = F.regexp_extract_all(F.col(text), F.lit(CASED_WORD), F.lit(0)), F.split(F.col(text), CASED_WORD, -1)
    pairs = F.arrays_zip(whole.alias("w"), gaps.alias("g"))
    kept = F.transform(pairs, lambda x, i: F.when(~F.array_contains(places, i + 1) & x["w"].isNotNull(), F.concat(x["g"], x["w"])).otherwise(""))
    cut = F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))
    return joined.withColumn(text, F.when(F.col(places).isNull(), F.col(text)).otherwise(cut)).select(*docs.columns)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT r, i, dw.n, item FROM dw JOIN bw USING (n, win)),
places AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hit)) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""
