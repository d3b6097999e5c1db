"""Secret scan: long unbroken strings and what credentials' names assign, and a random forest that removes the false positives.

Candidates are runs of 16 and more characters of keys, and values of any length and signs that a credential's name assigns. They are placed with what stands before and after them. Their features are length and kinds of characters, character
transitions, cover by a dictionary, path-likeness and neighbouring words. The dictionary are the words that many documents of the
corpus hold; transitions are the mean log-probability of pairs of characters in it, cover is the share of the candidate's
four-letter pieces that occur in it. The forest is fitted on labelled findings. There is no table of these among the inputs, so
``rule_labels`` marks the clear cases of the corpus itself: strings of letters and digits that a credential's name assigns are
secrets, as are published forms of keys and PEM lines; strings of letters alone that no name assigns, numbers, UUIDs and hashes
said to be some are not. Made findings add the hard cases (``made_findings``), part of them without the features that the rules
label by. The forest decides on all candidates.

Everything is DataFrame operations.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.llm.tables import stored, table

#: Labelled findings the forest is fitted on at most: those whose value hashes lowest.
MAX_LABELLED = 20_000
TREES, DEPTH, SEED = 30, 6, 7
THRESHOLD = 0.5
#: Documents that hold a word of the dictionary, at least; characters of the context on either side.
KNOWN_IN, CONTEXT = 3, 48
#: Names that credentials are assigned to, and words beside strings that are no credentials.
CREDENTIAL = r"(?:token|secret|passwd|password|passphrase|api[_-]?key|access[_-]?key|private[_-]?key|credential|auth(?!ors?\b))"
NAMES = rf"(?i)(?:\b[a-z0-9_-]*{CREDENTIAL}[a-z0-9_-]*\W{{0,3}}[:=]\W{{0,3}}(?:(?:bearer|basic|token)[ \t]+)?[\"'`]?|\bbearer[ \t]+)$"
#: A run; '=' belongs to it as trailing padding only.
RUN = r"[A-Za-z0-9+/_-]{16,}+(?:={1,2}+(?![A-Za-z0-9+/=_-]))?+"
#: What a credential's name assigns: to the closing quote, a run, or up to white space, a quote or the next parameter of a URL.
VALUE = rf"(?<=\")[^\"\n]++(?=\")|(?<=')[^'\n]++(?=')|(?<=`)[^`\n]++(?=`)|(?<!\w){RUN}(?![^\s\"'`&,;.)\]}}>])|[^\s\"'`&][^\s\"'`]*?(?=&[A-Za-z0-9_-]++=|[\s\"'`]|\z)"
#: A name is the part after the last '+' or '/' of a run, and begins where the run begins, so that each run is searched once.
ASSIGNED = rf"(?<![A-Za-z0-9+/_-])(?:[A-Za-z0-9+/_-]*[+/])?+(?=[A-Za-z0-9_-]*?(?i:{CREDENTIAL}))[A-Za-z0-9_-]++[\"'`\])]?[ \t]{{0,3}}[:=]{{1,3}}>?[ \t]{{0,3}}(?:(?i:bearer|basic|token)[ \t]{{1,3}})?+[\"'`]?"
#: Groups: the name and what assigns, the assigned value, or a run elsewhere.
CANDIDATE = rf"({ASSIGNED})({VALUE})|(?<![A-Za-z0-9+/_-])({RUN})"
#: What every candidate holds.
NECESSARY = rf"[A-Za-z0-9+/_-]{{16}}|(?i:{CREDENTIAL})"
#: Noncharacters that are put around candidates and between their groups.
AROUND, BETWEEN = "\ufdd0", "\ufdd1"
#: Parts of a text (candidates, each of six characters at least, and what lies between) that hold the context before a candidate.
BACK = 16
#: Signs that close a sentence or bracket and not an assigned value without quotes.
CLOSING = r"[.,;:()\[\]{}<>]+$"
#: Published forms of keys, and the inner lines of a PEM body.
FORMATS = r"^(?:gh[pousr]_[A-Za-z0-9]{30,}|github_pat_\w{30,}|(?:AKIA|ASIA)[A-Z0-9]{16}|xox[abprs]-[A-Za-z0-9-]{20,}|[sr]k_live_[A-Za-z0-9]{16,}|glpat-[\w-]{20,}|AIza[\w-]{35})$"
HASH = r"^(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{64})$"
UUID = r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"
#: Findings made of every sort of hard case.
MADE = 300
PEM = r"^(?=.*[a-z])(?=.*[A-Z])(?=.*[0-9])[A-Za-z0-9+/]{64}$"
HARMLESS = r"(?i)\b(?:example|sample|dummy|placeholder|test|sha1|sha256|md5|checksum|commit|digest|uuid)\b"
FEATURES = (
    "chars", "digits", "upper", "symbols", "kinds", "hexadecimal", "distinct", "transitions", "cover", "slashes", "after_path", "named", "quoted",
    "assigned", "harmless",
)


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, start, end, value, before, after, by_name)`` of every candidate, in code points, end exclusive.

    ``by_name``: a credential's name assigns it, however long the name. A text is searched once: candidates are marked in it, and it is cut at the marks. Places are sums of lengths over the parts
    before. The marks are the noncharacters U+FDD0 and U+FDD1, which are read as U+FFFD where a text holds them.
    """
    narrow = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.col("text").rlike(NECESSARY))
    body = F.translate("text", AROUND + BETWEEN, "\ufffd\ufffd")
    marked = narrow.select("row", "doc_id", F.split(F.regexp_replace(body, CANDIDATE, AROUND + BETWEEN.join(["$1", "$2", "$3"]) + AROUND), AROUND, -1).alias("parts"))
    # Part 2k + 1 is a candidate, part 2k what lies before it.
    bare = lambda x: F.right(F.translate(x, BETWEEN, ""), F.lit(CONTEXT))

    def part(i):
        place = 2 * i
        first = F.greatest(place - (BACK - 1), F.lit(1))
        before = F.array_join(F.transform(F.slice("parts", first, place - first), bare), "")
        return F.struct(
            i.alias("k"), F.length(F.get("parts", place - 2)).alias("gap"), F.get("parts", place - 1).alias("found"), F.right(before, F.lit(CONTEXT)).alias("lead"),
            F.left(F.get("parts", place), F.lit(CONTEXT)).alias("next"),
        )

    count = F.floor(F.size("parts") / 2).cast("int")
    numbered = marked.filter(count > 0).select("row", "doc_id", F.explode(F.transform(F.sequence(F.lit(1), count), part)).alias("p")).select("row", "doc_id", "p.*")
    groups = F.split("found", BETWEEN, -1)
    split = numbered.select("row", "doc_id", "k", "gap", "lead", "next", groups[0].alias("name"), groups[1].alias("held"), groups[2].alias("run"))
    whole = F.length("name") + F.length("held") + F.length("run")
    upto = F.sum(F.col("gap") + whole).over(Window.partitionBy("row").orderBy("k"))
    value = F.when(F.col("run") != "", F.col("run")).when(F.col("name").rlike("[\"'`]$"), F.col("held")).otherwise(F.regexp_replace("held", CLOSING, ""))
    placed = split.withColumn("value", value).withColumn("start", (upto - F.length("held") - F.length("run")).cast("int"))
    rest = F.substr(F.concat("held", "run"), F.length("value") + 1, F.lit(CONTEXT))
    return placed.filter("value <> ''").select(
        "doc_id", "start", (F.col("start") + F.length("value")).alias("end"), "value",
        F.right(F.concat("lead", F.right("name", F.lit(CONTEXT))), F.lit(CONTEXT)).alias("before"), F.left(F.concat(rest, "next"), F.lit(CONTEXT)).alias("after"), (F.col("name") != "").alias("by_name"),
    )


def dictionary(docs: DataFrame, text: str = "text", known_in: int = KNOWN_IN) -> DataFrame:
    """``(word, n)``: words of letters with the number of documents that hold them, at least ``known_in``."""
    words = F.array_distinct(F.split(F.lower(F.col(text)), r"[^\p{L}]+"))
    return docs.select(F.explode(words).alias("word")).filter("word <> ''").groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= known_in)


def _pieces(word: Column, length: int) -> Column:
    """All pieces of a length, one for each place; a shorter word is a piece itself."""
    every = F.regexp_extract_all(word, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))
    return F.when(F.length(word) < length, F.array(word)).otherwise(every)


def value_features(values: DataFrame, known: DataFrame) -> DataFrame:
    """``(value, transitions, cover)`` for each distinct ``value``.

    Pieces are joined as rows, which carry a number in place of the value, so the work is linear in a value's length; the tables of
    pieces hold at most one row per combination of letters.
    """
    pair_rows = known.select("n", F.explode(_pieces(F.col("word"), 2)).alias("piece")).groupBy("piece").agg(F.sum("n").cast("double").alias("n"))
    total = pair_rows.agg(F.sum("n")).first()[0] or 0.0
    lows = math.log(0.5 / (total + 1))
    pairs = pair_rows.select("piece", F.log(F.col("n") / (total + 1)).alias("score"))
    fours = known.filter(F.length("word") >= 4).select(F.explode(_pieces(F.col("word"), 4)).alias("piece")).distinct().withColumn("known", F.lit(1.0))
    numbered = stored(values.select("value").withColumn("number", F.monotonically_increasing_id()), "values")
    pieces = lambda n: numbered.select("number", F.explode(_pieces(F.lower("value"), n)).alias("piece"))
    twos = pieces(2).join(pairs, "piece", "left").groupBy("number").agg(F.avg(F.coalesce("score", F.lit(lows))).alias("transitions"))
    cover = pieces(4).join(fours, "piece", "left").groupBy("number").agg(F.avg(F.coalesce("known", F.lit(0.0))).alias("cover"))
    return numbered.join(twos, "number").join(cover, "number").drop("number")


def with_features(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with the columns ``FEATURES``; given findings may lack ``by_name``."""
    own = value_features(found.select("value").distinct(), known)
    value, size = F.col("value"), F.length("value")
    share = lambda pattern: F.length(F.regexp_replace(value, pattern, "")) / size
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "[a-z]+", "a"), "[A-Z]+", "A"), "[0-9]+", "0"), "[+/=_-]+", "_")
    yes = lambda c: c.cast("double")
    named = F.col("before").rlike(NAMES)
    if "by_name" in found.columns:
        named = named | F.col("by_name")
    joined = found.join(own, "value")
    return joined.select(
        *[f"`{c}`" for c in found.columns], F.least(size, F.lit(256)).cast("double").alias("chars"), share("[^0-9]").alias("digits"), share("[^A-Z]").alias("upper"),
        share("[A-Za-z0-9]").alias("symbols"), (F.length(kinds) / size).alias("kinds"), yes(value.rlike("^[0-9a-fA-F]+$")).alias("hexadecimal"),
        (F.size(F.array_distinct(F.split(value, ""))) / size).alias("distinct"), "transitions", "cover", share("[^/]").alias("slashes"),
        yes(F.col("before").rlike(r"[/.\\]$") | F.col("after").rlike(r"^[/.\\][A-Za-z]")).alias("after_path"), yes(named).alias("named"),
        yes(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")).alias("quoted"), yes(F.col("before").rlike(r"[:=]\W{0,3}$")).alias("assigned"),
        yes(F.col("before").rlike(HARMLESS)).alias("harmless"),
    )


def rule_labels(found: DataFrame) -> DataFrame:
    """Candidates that are clear by rule, with ``label`` 1.0 (secret) or 0.0."""
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]")
    line = F.col("before").rlike(r"(?:^|\n)$") & F.col("after").rlike(r"^(?:\n|$)")
    plain = F.col("harmless") == 0
    secret = ((F.col("named") == 1) & mixed & plain) | (F.col("value").rlike(FORMATS) & plain) | (F.col("value").rlike(PEM) & line)
    not_secret = ((F.col("assigned") == 0) & ~mixed) | ((F.col("harmless") == 1) & (F.col("named") == 0) & F.col("value").rlike(HASH)) | F.col("value").rlike(UUID)
    return found.withColumn("label", F.when(secret, 1.0).when(not_secret, 0.0)).filter("label is not null")


def made_findings(spark: SparkSession, each: int = MADE) -> DataFrame:
    """``(value, before, after, label)`` of hard cases, ``each`` of every sort, the same in every run: secrets that no name assigns or
    that are short, and strings of letters and digits that are none."""
    digest = lambda bits, salt: F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), bits)
    mixed = lambda n, salt: F.left(F.translate(F.base64(F.unhex(F.concat(digest(512, salt), digest(512, salt + "+")))), "+/=", "xYZ"), F.lit(n))
    base64 = lambda n, salt: F.left(F.base64(F.unhex(F.concat(digest(512, salt), digest(512, salt + "+")))), F.lit(n))
    hexes = lambda n, salt: F.left(digest(512, salt), F.lit(n))
    pick = lambda *words: F.element_at(F.array(*map(F.lit, words)), (F.pmod(F.xxhash64("id", F.lit(words[0])), F.lit(len(words))) + 1).cast("int"))
    uuid = F.concat_ws("-", *[F.substr(digest(256, "uuid"), F.lit(at), F.lit(n)) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    names = pick("src", "lib", "data", "images", "version", "release", "build", "assets")
    path = F.concat_ws("/", pick("usr", "var", "home", "opt"), names, F.concat(pick("local", "python", "chapter", "report"), hexes(1, "p")), F.concat(pick("index", "figure", "model", "notes"), F.pmod("id", F.lit(97))))
    prose, after = pick("see ", "use ", "the old one was ", "in ", "\n", "(", "with "), pick(" and ", " ", "\n", ". The", ")")
    sorts = [
        (1.0, F.concat(pick("ghp_", "gho_", "ghs_"), mixed(36, "gh")), prose, after),
        (1.0, F.concat(F.lit("AKIA"), F.upper(mixed(16, "aws"))), prose, after),
        (1.0, F.concat(pick("sk_live_", "xoxb-", "glpat-"), mixed(24, "live")), prose, after),
        (1.0, base64(64, "pem"), pick("\n", "-----BEGIN RSA PRIVATE KEY-----\n", "-----BEGIN PRIVATE KEY-----\n"), F.lit("\n")),
        (1.0, F.when(F.pmod("id", F.lit(2)) == 0, mixed(40, "bearer")).otherwise(hexes(40, "bearer")), pick("Authorization: Bearer ", "-H 'Authorization: Bearer ", "bearer "), pick("", "\n", "'")),
        (1.0, F.when(F.pmod("id", F.lit(2)) == 0, mixed(32, "env")).otherwise(hexes(32, "env")), pick("API_KEY=", "\nSECRET_TOKEN=", "get /x?access_token="), pick("", "\n", "&page=2", " ")),
        (1.0, F.concat(mixed(5, "pass"), pick("!", "&", "#", "", "$"), mixed(6, "word")), pick('password = "', "password: ", "passwd=", "password='"), pick('"', "\n", " ", "'")),
        (0.0, hexes(40, "commit"), F.concat(prose, pick("commit ", "fixed in commit ", "sha1 ", "")), after),
        (0.0, F.when(F.pmod("id", F.lit(2)) == 0, hexes(32, "md5")).otherwise(hexes(64, "sha")), F.concat(prose, pick("md5 ", "checksum: ", "sha256: ", "digest=")), after),
        (0.0, uuid, pick("id ", "uuid: ", "see ", "request "), after),
        (0.0, path, pick("/", "see ", "in ", "file "), pick(".py", ".png ", " ", "\n")),
        (0.0, pick("none", "required", "yes", "expired", "changed", "missing", "string", "unknown"), pick("password: ", "token = ", "auth: ", "secret="), pick("\n", " ", "")),
    ]
    made = [spark.range(each, numPartitions=1).select(v.alias("value"), b.alias("before"), a.alias("after"), F.lit(label).alias("label")) for label, v, b, a in sorts]
    return reduce(DataFrame.unionAll, made)


def masked(labelled: DataFrame) -> DataFrame:
    """Every fourth secret that is not hexadecimal loses what the rules label by, so that its shape decides; hexadecimal strings look
    like hashes without it and keep it."""
    hidden = (F.col("label") == 1) & (F.col("hexadecimal") == 0) & (F.pmod(F.xxhash64("value", F.lit("masked")), F.lit(4)) == 0)
    return labelled.withColumns({c: F.when(hidden, 0.0).otherwise(F.col(c)) for c in ("named", "quoted", "assigned")})


def secret_findings(docs: DataFrame, findings: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text", rows: int = MAX_LABELLED) -> DataFrame:
    """Every candidate: ``doc_id, start, end, value_sha256, score, is_secret``; values themselves are not passed on.

    ``findings``: labelled findings ``(value, before, after, label)``; without them the rules label the corpus's own
    and made ones are added. Where one of
    the two labels is missing, the score is the smoothed share of secrets among the labelled of the corpus. Null and empty texts have no
    candidates. Repeated rows each give their candidates.
    """
    known = stored(dictionary(docs, text), "dictionary")
    # Stored before the features are joined, so that texts are searched once.
    found = stored(with_features(stored(candidates(docs, doc_id, text), "placed"), known), "candidates")
    labelled = rule_labels(found) if findings is None else with_features(findings, known)
    # Equal findings are one, so that copies do not fill the sample.
    keyed = labelled.groupBy("value", "before", "label").agg(*[F.first(c).alias(c) for c in FEATURES])
    balance = F.xxhash64("value", "before")
    halves = [keyed.filter(F.col("label") == k).orderBy(balance, "value", "before").limit(rows // 2) for k in (0.0, 1.0)]
    sample = stored(halves[0].union(halves[1]).select("label", *FEATURES), "labelled_findings")
    counts = dict(sample.groupBy("label").count().collect())
    made = VectorAssembler(inputCols=list(FEATURES), outputCol="_features")
    if len(counts) < 2:
        share = (counts.get(1.0, 0) + 1) / (sum(counts.values()) + 2)
        scored = found.withColumn("score", F.lit(share))
    else:
        if findings is None:
            hard = masked(with_features(made_findings(docs.sparkSession), known)).select("label", *FEATURES)
            sample = stored(sample.union(hard), "training_findings")
        forest = RandomForestClassifier(featuresCol="_features", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED)
        model = forest.fit(made.transform(sample.coalesce(1).sortWithinPartitions(*FEATURES, "label")))
        scored = model.transform(made.transform(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), F.sha2("value", 256).alias("value_sha256"), "score", (F.col("score") >= THRESHOLD).alias("is_secret"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_findings(table(spark, sf_dir, "documents"))
