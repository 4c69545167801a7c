import hashlib
import random

from pyspark.sql import functions as F

from sparkcdc.llm import chat


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_format(turns):
    """(text, loss spans) of a conversation."""
    out, spans = "", []

    def esc(s):
        s = s.replace("\\", "\\\\")
        for m in chat.CONTROL:
            s = s.replace(m, ("\\l" if m[0] == "<" else "\\b") + m[1:])
        return s

    for role, text in turns:
        out += chat.START + esc(role).replace("\n", "\\n") + "\n"
        if role == "assistant":
            spans.append((len(out), len(out) + len(esc(text))))
        out += esc(text) + chat.END + "\n"
    return out, spans


def test_escaping_reads_back(spark):
    rng = random.Random(2)
    parts = [*chat.CONTROL, "\\", "l", "b", "n", "<", "[", "\n", " ", "é🙂", "<|im_", "end|>", "\\l", "\\\\b"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"), chat.escape_role(F.col("t")).alias("r"))
    for r in df.select("t", "e", "r", chat.unescape(F.col("e")).alias("back"), chat.unescape(F.col("r")).alias("role")).collect():
        assert r.back == r.role == r.t and "\n" not in r.r and not any(m in r.e for m in chat.CONTROL)


def test_trees_against_walking(spark):
    rng = random.Random(3)
    nodes, want = [], {}
    for tree in range(12):
        size = rng.choice([1, 2, 7, 40, 150])
        parents = {i: (None if i == 0 or rng.random() < 0.03 else (i - 1 if rng.random() < 0.8 else rng.randrange(i))) for i in range(size)}
        told = {i: (rng.choice(["user", "assistant"]), f"t{tree}-{i}", rng.choice([0.0, 1.0, 2.0, None])) for i in range(size)}
        nodes += [(tree if tree else None, i, parents[i], *told[i], "extra") for i in range(size)]
        for leaf in set(range(size)) - set(parents.values()):
            path = [leaf]
            while parents[path[0]] is not None:
                path.insert(0, parents[path[0]])
            want[tree if tree else None, leaf] = (plain_format([told[i][:2] for i in path]), sum(told[i][2] or 0 for i in path) / len(path))
    # A cycle, a repeated row, a parent that is not there.
    nodes += [(99, 1, 2, "user", "x", 0.0, "e"), (99, 2, 1, "user", "y", 0.0, "e"), nodes[0], (98, 5, 77, None, None, None, "e")]
    want[98, 5] = (plain_format([("", "")]), 0.0)
    df = spark.createDataFrame(nodes, "tree bigint, id bigint, parent bigint, role string, text string, score double, leaf string")
    table = chat.messages(df, tree="tree", id="id", parent="parent", role="role", text="text", score="score")
    got = {(r.tree.tree, r.leaf): (r.conversation, [tuple(x) for x in r.loss]) for r in chat.formatted(chat.ranked_paths(table)).collect()}
    assert got == {k: v[0] for k, v in want.items()}
    best = chat.formatted(chat.ranked_paths(table, keep=2)).collect()
    by_tree = {}
    for (tree, leaf), (_, score) in want.items():
        by_tree.setdefault(tree, []).append((-score, leaf))
    assert {(r.tree.tree, r.leaf) for r in best} == {(t, leaf) for t, rows in by_tree.items() for _, leaf in sorted(rows)[:2]}


def test_rows_of_every_sort(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"turn {i} [INST]") for i in range(300)]
    rows += [(2, None, None, None), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a"), (None, 3, "assistant", "\\<s>"), (3, 0, "assistant", "z" * 100_000)]
    df = spark.createDataFrame(rows, "c bigint, t bigint, role string, text string").withColumn("id", F.lit(1)).withColumn("tree", F.lit("t"))
    nodes = chat.numbered_turns(df, "c", "t", "role", "text")
    got = {r.conv_id: r for r in chat.digests(chat.formatted(chat.ranked_paths(nodes))).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        turns = sorted((-1 if t is None else t, role or "", text or "") for c, t, role, text in rows if c == conv)
        learned = "".join(x for _, role, x in turns if role == "assistant")
        told = "".join(f"{role}\n{x}\n" for _, role, x in turns)
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), sha(told), len(learned), sha(learned))
        assert r.formatted_chars == len(plain_format([t[1:] for t in turns])[0])
    empty = chat.numbered_turns(df.where("false"), "c", "t", "role", "text")
    assert chat.formatted(chat.ranked_paths(empty)).count() == 0
