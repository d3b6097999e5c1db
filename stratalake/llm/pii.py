"""Personal data: fixed forms, and the words of their lines that give them away.

Base forms are found by patterns whose matches are placed by adding up lengths of matches and gaps. The information-theoretic
part protects every found value (an entity) against the words of the lines it stands on. Over all lines of the corpus, a word
``t`` tells ``PMI(c; t) = ln(N n(c,t) / (n(c) n(t)))`` about entity ``c``, whose own information is ``IC(c) = ln(N / n(c))``.
A word discloses the entity when ``PMI >= disclosure * IC``; an entity that stands on one line takes part like any other, as a
word found only there tells all about it. A single line with both counts when it tells more than one bit (by chance they would meet
on less than half a line), which rules out coincidences in corpora of a few lines. The word is generalised to its first
letters if the class of words with these letters stays below the threshold for the same entity, and removed otherwise.

Everything is column expressions. Counts cover all lines of all documents and combine in the map tasks. Only lines with an
entity are carried along with their text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.tables import free_name, stored, table

DISCLOSURE = 0.9
#: Lines that hold both the word and the entity, at least; 1 leaves the decision to the threshold alone.
SUPPORT = 1
CLASS_LETTERS = 3
KINDS = ("email", "ip", "card", "phone")
#: A match never starts inside a run of its first characters unless the match before ended there, so scans stay linear;
#: possessive repeats need no stack.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold to have a match of the kind that counts.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
LETTERS = r"\p{L}+"
SPANS = "array<struct<start:int,end:int,value:string>>"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum of card numbers, second digits from the right doubled."""

    def add(total, i):
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        twice = 2 * digit
        return total + F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _counts(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.when(F.length(_digits(match)).between(16, 19), _luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(match)).between(8, 15)
    return F.lit(True)


def _placed(text: Column, pattern: str, keep) -> Column:
    """Spans (code points, end exclusive) of the leftmost matches that do not overlap and that ``keep`` takes."""
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), x["match"].alias("value"))
        more = F.concat(state["spans"], F.array(span).cast(SPANS))
        return F.struct(end.alias("at"), F.when(x["match"].isNotNull() & keep(x["match"]), more).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(pairs, empty, step, lambda state: state["spans"])


def base_spans(text: Column) -> Column:
    """Struct of a span array for each kind. A null text has none."""
    none = F.array().cast(SPANS)
    made = []
    for kind in KINDS:
        likely = text.contains("@") if kind == "email" else text.rlike(NEEDS[kind])
        found = _placed(text, PATTERNS[kind], lambda m, kind=kind: _counts(kind, m))
        made.append(F.when(text.isNotNull() & likely, found).otherwise(none).alias(kind))
    return F.struct(*made)


def _total(spans: Column) -> Column:
    return reduce(lambda a, b: a + b, (F.size(spans[k]) for k in KINDS))


def _written(kind: str, spans: Column) -> Column:
    return F.transform(spans, lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")))


def _terms(line: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(F.lower(line), r"[^\p{L}]+"), ""))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """``(term, n)``: lines that hold the word, over all lines; the empty word counts the lines."""
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
    return lines.select(F.explode(F.concat(F.array(F.lit("")), _terms(F.col("line")))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))


def entity_lines(marked: DataFrame, row: str, text: str) -> DataFrame:
    """``(row, line_no, at, line, entities)`` of the lines with a base span; ``at`` is the line's place in the text."""
    lines = F.split(F.col(text), "\n", -1)
    starts = F.aggregate(lines, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.length(x) + 1)))
    split = marked.select(F.col(row).alias("row"), F.posexplode(F.arrays_zip(lines.alias("line"), starts.alias("at"))).alias("line_no", "x"))
    split = split.select("row", "line_no", "x.at", "x.line").withColumn("s", base_spans(F.col("line")))
    named = [F.transform(F.col("s")[k], lambda s, k=k: F.concat(F.lit(f"{k}:"), F.lower(s["value"]))) for k in KINDS]
    return split.withColumn("entities", F.array_distinct(F.concat(*named))).filter(F.size("entities") > 0).select("row", "line_no", "at", "line", "entities")


def disclosing_terms(lines: DataFrame, counts: DataFrame, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``(entity, term, replacement)`` for every word that gives an entity away; counts are those of the corpus."""
    n_lines = counts.filter("term = ''").agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    bare = reduce(lambda c, k: F.regexp_replace(c, PATTERNS[k], " "), KINDS, F.col("line"))
    pairs = lines.select(F.explode("entities").alias("entity"), _terms(bare).alias("terms")).select("entity", F.explode("terms").alias("term"))
    pairs = pairs.groupBy("entity", "term").agg(F.count("*").alias("n_ct"))
    entities = lines.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_c"))
    first = lambda c: F.substring(c, 1, CLASS_LETTERS).alias("class")
    classes = counts.filter("term <> ''").groupBy(first("term")).agg(F.sum("n").alias("n_g"))
    class_pairs = pairs.groupBy("entity", first("term")).agg(F.sum("n_ct").alias("n_cg"))

    def tells(together: str, alone: str) -> Column:
        return F.log(F.lit(n_lines) * F.col(together) / (F.col("n_c") * F.col(alone))) >= disclosure * F.log(F.lit(n_lines) / F.col("n_c")) - 1e-9

    met = (F.col("n_ct") > 1) | (F.col("n_c") * F.col("n") * 2 < n_lines)
    told = pairs.filter(F.col("n_ct") >= support).join(counts, "term").join(entities.filter(F.col("n_c") < n_lines), "entity").filter(tells("n_ct", "n") & met)
    told = told.select("entity", "term", "n_c", first("term")).join(classes, "class").join(class_pairs, ["entity", "class"])
    wide = ~tells("n_cg", "n_g") & (F.length("term") > 2 * CLASS_LETTERS)
    return told.select("entity", "term", F.when(wide, F.concat("class", F.lit("*"))).otherwise("[TERM]").alias("replacement"))


def term_spans(marked: DataFrame, docs: DataFrame, row: str, text: str, disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """``(row, terms)``: the placed words to replace, ``value`` being the replacement, of documents that have any."""
    lines = stored(entity_lines(marked, row, text), "entity_lines")
    counts = stored(word_counts(docs, text), "word_counts")
    told = disclosing_terms(lines, counts, disclosure, support)
    chosen = lines.select("row", "line_no", F.explode("entities").alias("entity")).join(told, "entity")
    # A word that two entities give different replacements is removed.
    chosen = chosen.groupBy("row", "line_no", "term").agg(F.when(F.min("replacement") == F.max("replacement"), F.min("replacement")).otherwise("[TERM]").alias("r"))
    chosen = chosen.groupBy("row", "line_no").agg(F.map_from_entries(F.collect_list(F.struct("term", "r"))).alias("told"))
    found = lines.join(chosen, ["row", "line_no"])
    told_word = lambda word: F.element_at(F.col("told"), F.lower(word))
    base = F.flatten(F.array(*[base_spans(F.col("line"))[k] for k in KINDS]))
    words = _placed(F.col("line"), LETTERS, lambda m: told_word(m).isNotNull())
    found = found.select("row", "at", "told", base.alias("base"), words.alias("words"))
    free = F.filter("words", lambda w: ~F.exists("base", lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    moved = F.transform(free, lambda w: F.struct((w["start"] + F.col("at")).alias("start"), (w["end"] + F.col("at")).alias("end"), told_word(w["value"]).alias("value")))
    return found.select("row", moved.alias("t")).groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("t"))).alias("terms"))


def replaced(text: Column, spans: Column) -> Column:
    """The text with each span (sorted by start) replaced by its value; spans that overlap go together."""
    empty = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, s):
        between = F.substr(text, state["at"] + 1, s["start"] - state["at"])
        new = s["start"] >= state["at"]
        out = F.when(new, F.concat(state["out"], between, s["value"])).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, empty, step, lambda state: F.concat(state["out"], F.substr(text, state["at"] + 1, F.length(text))))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, counts of the base kinds, ``base_sha256``, ``spans`` (with ``term`` spans
    after the base ones) and ``n_term``. Null texts count as empty; repeated rows each give a row and count in the corpus.
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    marked = narrow.select("*", base_spans(F.col("text")).alias("spans"), F.monotonically_increasing_id().alias("row"))
    marked = stored(marked.withColumn("text", F.when(_total(F.col("spans")) > 0, F.col("text"))), "personal")
    terms = term_spans(marked.filter("text is not null"), narrow, "row", "text", disclosure, support)
    base = F.concat(*[_written(k, F.col("spans")[k]) for k in KINDS])
    joined = marked.join(terms, "row", "left").withColumn("terms", F.coalesce("terms", F.array().cast(SPANS)))
    return joined.select(
        "doc_id", *[F.size(F.col("spans")[k]).cast("long").alias(f"n_{k}") for k in KINDS], F.sha2(F.array_join(base, ","), 256).alias("base_sha256"),
        F.array_join(F.concat(base, _written("term", F.col("terms"))), ",").alias("spans"), F.size("terms").cast("long").alias("n_term"),
    )


def sanitised(docs: DataFrame, text: str = "text", length: str = "n_chars", disclosure: float = DISCLOSURE, support: int = SUPPORT) -> DataFrame:
    """All documents and columns; base spans become ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``, disclosing words their
    general form or ``[TERM]``. A column of text lengths, if there, follows. Other documents stay as they are.
    """
    spans, row, terms = (free_name(docs, x) for x in ("spans", "row", "terms"))
    marked = stored(docs.withColumn(spans, base_spans(F.col(text))).withColumn(row, F.monotonically_increasing_id()), "personal")
    some = _total(F.col(spans)) > 0
    told = term_spans(marked.filter(some), docs, row, text, disclosure, support).select(F.col("row").alias(row), F.col("terms").alias(terms))
    tag = lambda k: F.transform(F.col(spans)[k], lambda s: F.struct(s["start"], s["end"], F.lit(f"[{k.upper()}]").alias("value")))
    every = F.array_sort(F.concat(*[tag(k).cast(SPANS) for k in KINDS], F.coalesce(F.col(terms), F.array().cast(SPANS))))
    changed = marked.filter(some).join(told, row, "left").withColumn(terms, every).withColumn(text, replaced(F.col(text), F.col(terms)))
    if length in docs.columns:
        changed = changed.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return marked.filter(~some).select(*docs.columns).union(changed.select(*docs.columns))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))
