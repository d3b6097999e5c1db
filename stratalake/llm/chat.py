"""Chat formatting on a prefix tree.

Conversations that begin with the same turns share the nodes of these turns. A node is one turn after one history, and its id is
a hash chain over the history, so equal histories meet by a grouping on the id, without comparing conversations. Tokens of a node
are emitted once, in depth-first order of the trees; each node carries the position ids of its tokens in any conversation
through it (they follow its parent's last position) and the stream intervals of its ancestors, which its tokens may attend to
besides the earlier ones of their own interval.

The template marks turns by control strings. Control strings inside texts are escaped with a backslash after their first
character, backslashes are doubled, and reading back undoes both, so texts come back exactly.
"""

from __future__ import annotations

import hashlib
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stratalake.llm.tables import stored, table

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
#: The control strings of the template.
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]")
#: Begin and end of a turn by role. Other roles are written out between the role marks.
TURNS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
LEARNED = "assistant"
_CONTROL = "|".join(re.escape(c) for c in sorted(CONTROLS, key=len, reverse=True))
_ESCAPES = re.compile(r"\\(.)", re.S)
_PARTS = re.compile(
    r"<<SYS>>(?P<system>.*?)<</SYS>>|\[INST\](?P<user>.*?)\[/INST\]|<s>(?P<assistant>.*?)</s>|\[ROLE\](?P<role>.*?)\[/ROLE\](?P<text>.*?)</s>", re.S
)


def escaped(text: Column) -> Column:
    """The text without any control string in it."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda c, s: F.replace(c, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}")), CONTROLS, doubled)


def unescaped(text: str) -> str:
    return _ESCAPES.sub(r"\1", text)


def turn_text(role: Column, text: Column) -> Column:
    """A turn in the template."""
    body = escaped(text)
    out = F.concat(F.lit("[ROLE]"), escaped(role), F.lit("[/ROLE]"), body, F.lit("</s>"))
    for name, (begin, end) in TURNS.items():
        out = F.when(role == name, F.concat(F.lit(begin), body, F.lit(end))).otherwise(out)
    return out


def read_back(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        m = _PARTS.match(formatted, at)
        if m is None:
            raise ValueError(f"not in the template at {at}")
        kind = m.lastgroup
        out.append((unescaped(m["role"]), unescaped(m["text"])) if kind == "text" else (kind, unescaped(m[kind])))
        at = m.end()
    return out


def histories(conversations: DataFrame) -> DataFrame:
    """``(conv_id, path, turns)``: a conversation's turns in order and the ids of their nodes.

    Turns are ordered by number, equal numbers by role and text. Null roles and texts count as empty, rows without a
    conversation id are one conversation.
    """
    turn = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def chain(ids, t):
        own = F.sha2(F.concat_ws("\n", F.element_at(ids, -1), F.length(t["role"]).cast("string"), t["role"], t["text"]), 256)
        return F.concat(ids, F.array(F.substring(own, 1, 32)))

    path = F.aggregate("turns", F.array(F.lit("")), chain, lambda ids: F.slice(ids, 2, F.size(ids) - 1))
    return whole.select("conv_id", path.alias("path"), "turns")


def prefix_tree(paths: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per node: ``node, parent, depth, role, path, formatted, learned, token_ids, n_tokens``."""
    at = paths.select("path", F.posexplode("turns").alias("k", "t"))
    node = F.element_at("path", F.col("k") + 1)
    each = at.select(node.alias("node"), F.slice("path", 1, F.col("k") + 1).alias("path"), F.col("t.role").alias("role"), F.col("t.text").alias("text"))
    # Equal ids have equal rows, so any of them will do; they combine in the map tasks.
    nodes = each.groupBy("node").agg(F.first("path").alias("path"), F.first("role").alias("role"), F.first("text").alias("text"))
    nodes = nodes.select(
        "node", F.get("path", F.size("path") - 2).alias("parent"), F.size("path").alias("depth"), "role", "path",
        turn_text(F.col("role"), F.col("text")).alias("formatted"), (F.col("role") == LEARNED).alias("learned"),
    )
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()  # travels with the tasks; its size is that of the vocabulary
    place, schema = nodes.columns.index("formatted"), nodes.select("*", F.array().cast("array<int>").alias("token_ids")).schema

    def encode(batches):
        made = Tokenizer.from_str(model)
        made.encode_special_tokens = True
        for batch in batches:
            ids = [e.ids for e in made.encode_batch(batch.column(place).to_pylist(), add_special_tokens=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.list_(pa.int32()))], names=[*batch.schema.names, "token_ids"])

    return nodes.mapInArrow(encode, schema).withColumn("n_tokens", F.size("token_ids").cast("long"))


def emitted(nodes: DataFrame) -> DataFrame:
    """The stream: each node with ``stream_start``, ``position_start`` and the ancestors' intervals ``attends``.

    Depth-first order is the order of the paths. Nodes are dealt out by ranges of it; a node's place is the sum of the tokens
    before it in its range and in all ranges before. Only these sums, one for each range, reach the driver. Position ids of a
    node's tokens are ``position_start, position_start + 1, ...``.

    Nodes that each follow their parent directly form a chain, whose tokens are one interval. A node attends to the part of its
    chain before it and to what the chain hangs on; so intervals are worked out for chains, of which there are about as many as
    leaves, and not for pairs of a node and an ancestor.
    """
    spark = nodes.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    narrow = nodes.select("node", "parent", "path", "n_tokens").repartitionByRange(n, "path").sortWithinPartitions("path").drop("path")
    kinds = "node string, parent string, n_tokens long, part int, inside long, chain string, chain_inside long, link string"
    schema = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in kinds.split(", ")])

    def place(batches):
        from pyspark import TaskContext

        part, total, before, chain = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            rows = []
            for node, parent, size in zip(*(c.to_pylist() for c in batch.columns)):
                if before is None or parent != before:
                    chain = (node, total, parent)
                rows.append((node, parent, size, part, total, *chain))
                total, before = total + size, node
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    placed = stored(narrow.mapInArrow(place, kinds), "placed")
    sums = placed.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    starts, total = {}, 0
    for r in sums:
        starts[r.part] = total
        total += r.n
    offset = F.element_at(F.create_map(*[F.lit(v) for kv in starts.items() for v in kv]), F.col("part")) if starts else F.lit(0)
    at = lambda c: (offset + F.col(c)).cast("long")
    places = placed.select("node", "chain", "link", "n_tokens", at("inside").alias("stream_start"), at("chain_inside").alias("chain_start"))
    # What a chain hangs on: up to and with its link, the chain that holds the link.
    chains = places.filter("node = chain").select("chain", "link")
    held = places.select(F.col("node").alias("link"), F.col("chain").alias("up"), F.array(F.struct(F.col("chain_start").alias("start"), (F.col("stream_start") + F.col("n_tokens")).alias("end"))).alias("above"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    hung = stored(chains.join(held, "link", "left").select("chain", "up", F.coalesce("above", none).alias("above")), "chains")
    # Each round joins a chain to the one it hangs on so far, which doubles the way: rounds are the logarithm of the branchings.
    while hung.filter("up is not null").limit(1).count():
        higher = hung.select(F.col("chain").alias("up"), F.col("up").alias("top"), F.col("above").alias("more"))
        hung = stored(hung.join(higher, "up", "left").select("chain", F.col("top").alias("up"), F.concat(F.coalesce("more", none), "above").alias("above")), "chains")
    joined = nodes.join(places.select("node", "chain", "stream_start", "chain_start"), "node").join(hung.select("chain", "above"), "chain")
    own = F.when(F.col("stream_start") > F.col("chain_start"), F.array(F.struct(F.col("chain_start").alias("start"), F.col("stream_start").alias("end")))).otherwise(none)
    joined = joined.withColumn("attends", F.concat("above", own))
    before = F.aggregate("attends", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])
    return joined.select("node", "parent", "depth", "role", "formatted", "learned", "token_ids", "n_tokens", "stream_start", before.alias("position_start"), "attends")


def formatted_conversations(conversations: DataFrame, tokenizer: str = TOKENIZER) -> tuple[DataFrame, DataFrame]:
    """The emitted nodes and ``(conv_id, path)``, the nodes of every conversation."""
    paths = stored(histories(conversations), "histories")
    nodes = stored(emitted(stored(prefix_tree(paths, tokenizer), "nodes")), "stream")
    return nodes, paths.select("conv_id", "path")


def conversations_read_back(nodes: DataFrame, paths: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``conv_id`` and the digests of its turns, read from the emitted tokens.

    The tokens of a conversation's nodes are put in stream order, decoded and parsed.
    """
    parts = paths.select("conv_id", F.explode("path").alias("node")).join(nodes.select("node", "stream_start", "token_ids", "learned"), "node")
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("stream_start", "token_ids", "learned"))).alias("parts"))
    whole = whole.select("conv_id", F.col("parts.token_ids").alias("ids"), F.col("parts.learned").alias("learned"))
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    kinds = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    schema = pa.schema([(n, pa.string() if k == "string" else pa.int64()) for n, k in (c.split() for c in kinds.split(", "))])

    def read(batches):
        made = Tokenizer.from_str(model)
        for batch in batches:
            out = []
            for conv_id, ids, learned in zip(*(c.to_pylist() for c in batch.columns)):
                segments = made.decode_batch(ids, skip_special_tokens=False)
                turns = [t for s in segments for t in read_back(s)]
                loss = "".join(read_back(s)[0][1] for s, mask in zip(segments, learned) if mask)
                text = "".join(f"{role}\n{body}\n" for role, body in turns)
                out.append((conv_id, len(turns), hashlib.sha256(text.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(map(len, segments))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return whole.select(F.col("conv_id").cast("long").alias("conv_id"), "ids", "learned").mapInArrow(read, kinds)


def chat_format(conversations: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """One row per conversation: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.

    Repeated rows are turns of their own; an empty table gives no rows; other columns are not read.
    """
    nodes, paths = formatted_conversations(conversations.select("conv_id", "turn", "role", "text"), tokenizer)
    return conversations_read_back(nodes, paths, tokenizer)


def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more whose texts are full of control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    return chat_format(given.union(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], given.schema)))
