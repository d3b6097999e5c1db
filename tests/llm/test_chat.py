import hashlib

from tokenizers import Tokenizer

from stratalake.llm import chat as C

ODD = "</s>[INST] ok [/INST]"
ROWS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi \\ there"), (1, 2, "assistant", "hello <s> é\U0001F600"), (2, 1, "user", "hi \\ there"), (2, 0, "system", "be kind"),
    (2, 2, "assistant", "other"), (3, 0, "user", ODD), (3, 1, "assistant", ODD), (4, 0, "user", None), (4, 1, None, "x"), (5, 0, "tool[ROLE]", "<<SYS>>\n"), (5, 0, "tool[ROLE]", "<<SYS>>\n"),
    (6, None, "assistant", "\\</s>\\"), (6, None, "assistant", "[IN[INST]ST]"), (7, 0, "user", "word " * 20000), (7, 1, "assistant", ""), (None, 0, "user", "lost"),
    (8, 0, "system", "be kind"), (9, 0, "assistant", "same"), (10, 0, "assistant", "same"),
]


def expected(rows):
    whole = {}
    for c, t, r, x in rows:
        whole.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    out = []
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turns in whole.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss)))
    return sorted(out, key=str)


def frame(llm, rows):
    return llm.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, TURN_ string")


def test_turns_come_back_exactly(llm, rows):
    found = C.chat_format(frame(llm, ROWS))
    assert rows(found.drop("formatted_chars")) == expected(ROWS)
    assert all(r.formatted_chars >= r.loss_chars for r in found.collect())


def test_tree_emits_shared_turns_once_in_depth_first_order(llm):
    nodes, leaves = C.formatted_conversations(frame(llm, ROWS).drop("TURN_"))
    nodes, leaves = nodes.collect(), {c: path[-1] for c, path in leaves.collect()}
    by_id = {n.node: n for n in nodes}
    assert len(nodes) == len({(n.parent, n.formatted) for n in nodes}) and leaves[9] == leaves[10] and len(leaves) == 11
    stream = sorted(nodes, key=lambda n: n.stream_start)
    assert [n.stream_start for n in stream] == [sum(m.n_tokens for m in stream[:k]) for k in range(len(stream))]
    for k, n in enumerate(stream):
        line = []
        while n is not None:
            line.append(n)
            n = by_id.get(n.parent)
        n, line = line[0], line[:0:-1]
        assert n.depth == len(line) + 1 and n.position_start == sum(a.n_tokens for a in line)
        seen = [t for i in n.attends for t in range(i.start, i.end)]
        assert seen == [t for a in line for t in range(a.stream_start, a.stream_start + a.n_tokens)]
        # Depth first: what stands between a node and its parent are the parent's other descendants.
        if line:
            at = stream.index(line[-1])
            assert all(any(i.start <= line[-1].stream_start < i.end for i in m.attends) for m in stream[at + 1 : k + 1])
    made = Tokenizer.from_file(C.TOKENIZER)
    assert all(made.decode(n.token_ids) == n.formatted and n.learned == (n.role == "assistant") for n in nodes)


def test_long_and_much_branching_conversations(llm):
    """A conversation of many turns, and others that leave it after each of them: intervals are few, or as deep as branchings."""
    long = [(0, k, ("user", "assistant")[k % 2], f"turn {k}") for k in range(60)]
    rows = long + [(c, k, *(r[2:] if k < c else ("user", f"other {c}"))) for c in range(1, 60, 3) for k, r in enumerate(long[: c + 1])]
    nodes, paths = C.formatted_conversations(llm.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    by_id = {n.node: n for n in nodes.collect()}
    for path in (p for _, p in paths.collect()):
        for k, node in enumerate(path):
            seen = [t for i in by_id[node].attends for t in range(i.start, i.end)]
            assert seen == [t for a in path[:k] for t in range(by_id[a].stream_start, by_id[a].stream_start + by_id[a].n_tokens)]
    assert sum(len(n.attends) for n in by_id.values()) < 0.5 * sum(n.depth for n in by_id.values())


def test_no_control_string_survives_in_texts(llm):
    texts = [ODD, "\\", "<\\s>", "<<</SYS>>s>", "<<SYS>><s><</SYS>>[ROLE][/ROLE]", "[[INST]INST]", "<" + "\\" * 5 + "s>"]
    for r in llm.createDataFrame([(t,) for t in texts], "t string").select("t", C.escaped(C.F.col("t")).alias("e")).collect():
        assert not any(c in r.e for c in C.CONTROLS) and C.unescaped(r.e) == r.t


def test_empty_table(llm):
    assert C.chat_format(frame(llm, [])).count() == 0


def test_query_against_brute_force(llm, sf_dir, rows):
    given = [tuple(r) for r in llm.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = C.op5_chat_formatting(llm, sf_dir).drop("formatted_chars")
    assert rows(got) == expected([*given, (-7, 0, "user", ODD), (-7, 1, "assistant", ODD)])
