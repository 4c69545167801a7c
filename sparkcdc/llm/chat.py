"""Chat formatting of reply trees. DataFrame functions only.

Messages point to their parents. Ancestors 1, 2, 4, ... levels up are found by iterative self-joins; from
every leaf the path to the root is then enumerated by taking each jump or not, so a path of n messages
takes log2(n) joins and the rows are exactly the messages of the paths. Branches are ranked by score, and
each chosen path is formatted as one conversation with the spans that a loss is taken over.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``. In texts and roles a backslash
becomes two, and the first character of any control string becomes ``\\l`` (for ``<``) or ``\\b`` (for ``[``);
in roles a line end becomes ``\\n``. ``unescape`` reads that back.

Nulls and ties: a null text or role is empty; a null tree id is a tree of its own; a message whose parent
is null or missing is a root; a null score counts 0. Rows that repeat a message id are one message, the
one with the least (role, text). Messages on a cycle have no leaf below or no root above and are in no
path. Equal scores rank by the leaf's id. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkcdc.llm.common import sha256, written
from sparkcdc.operators.ordered import running

#: The template's marks and the control strings of common templates, escaped inside texts.
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = (START, END, "<|im_sep|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
#: Turns that are put together before a conversation's parts are.
PART = 64


def escape(text: Column) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(("\\l" if mark[0] == "<" else "\\b") + mark[1:]))
    return out


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: Column) -> Column:
    """Between doubled backslashes, found from the left, every backslash starts a short form."""

    def plain(part: Column) -> Column:
        for short, char in (("\\l", "<"), ("\\b", "["), ("\\n", "\n")):
            part = F.replace(part, F.lit(short), F.lit(char))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def numbered_turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """A conversation table as messages: ``tree``, ``id`` (1-based place by turn, role, text), ``parent``.

    Places are counted in buckets of turns, so that a long conversation is not one task's.
    """
    named = rows.select(
        F.struct(F.col(conv).alias("tree")).alias("tree"),
        F.coalesce(F.col(turn), F.lit(-(2**62))).cast("bigint").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    placed = running(named, ["tree"], "turn", {"id": ("count", F.lit(1))}, PART, ["role", "text"], inclusive=True)
    return placed.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def messages(rows: DataFrame, *, tree: str, id: str, parent: str, role: str, text: str, score: str | None = None) -> DataFrame:  # noqa: A002
    """A table of messages in the form the other functions take: one row per message of a tree."""
    value = F.lit(0.0) if score is None else F.coalesce(F.col(score).cast("double"), F.lit(0.0))
    named = rows.select(
        F.struct(F.col(tree).alias("tree")).alias("tree"), F.col(id).alias("id"), F.col(parent).alias("parent"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"), value.alias("score"),
    ).where("id IS NOT NULL")
    first = F.min(F.struct("role", "text", "parent", "score")).alias("m")
    return named.groupBy("tree", "id").agg(first).select("tree", "id", "m.parent", "m.role", "m.text", "m.score")


def paths(nodes: DataFrame) -> DataFrame:
    """``tree``, ``leaf``, ``id`` and ``up`` (0 at the leaf) of every message of every root-to-leaf path."""
    known = nodes.select("tree", F.col("id").alias("up_id"))
    links = nodes.select("tree", "id", F.col("parent").alias("up_id")).join(known, ["tree", "up_id"], "left_semi")
    jumps = [written(links.select("tree", "id", "up_id"), "chat-jumps")]
    # 2**k levels up from 2**(k-1) levels up; a cycle is cut off where a tree could not be as deep.
    total = nodes.count()
    while not jumps[-1].isEmpty() and 2 ** len(jumps) <= 2 * total:
        half = jumps[-1]
        onward = half.select("tree", F.col("id").alias("up_id"), F.col("up_id").alias("far"))
        jumps.append(written(half.join(onward, ["tree", "up_id"]).select("tree", "id", F.col("far").alias("up_id")), "chat-jumps"))
    leaves = nodes.select("tree", "id").join(jumps[0].select("tree", F.col("up_id").alias("id")), ["tree", "id"], "left_anti")
    rows = leaves.select("tree", F.col("id").alias("leaf"), "id", F.lit(0).cast("bigint").alias("up"))
    for level in range(len(jumps) - 1, -1, -1):
        moved = rows.join(jumps[level], ["tree", "id"]).select("tree", "leaf", F.col("up_id").alias("id"), (F.col("up") + 2**level).alias("up"))
        rows = written(rows.union(moved), "chat-paths") if level % 4 == 0 else rows.union(moved)
    return rows


def ranked_paths(nodes: DataFrame, keep: int | None = None) -> DataFrame:
    """Path messages with role and text, and each path's mean ``path_score``; with ``keep``, of the best
    paths of each tree only. Ranks are taken in salted shares first, so no tree is one task's."""
    rows = paths(nodes).join(nodes.select("tree", "id", "role", "text", "score"), ["tree", "id"])
    if keep is None:
        return rows
    rows = written(rows, "chat-rows")
    scores = rows.groupBy("tree", "leaf").agg(F.avg("score").alias("path_score"))
    salted = scores.withColumn("salt", F.pmod(F.xxhash64("leaf"), F.lit(PART)))
    order = [F.col("path_score").desc(), F.col("leaf")]
    share = Window.partitionBy("tree", "salt").orderBy(*order)
    whole = Window.partitionBy("tree").orderBy(*order)
    few = salted.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= keep)
    best = few.withColumn("rank", F.row_number().over(whole)).where(F.col("rank") <= keep)
    return rows.join(best.select("tree", "leaf", "path_score", "rank"), ["tree", "leaf"])


def formatted(rows: DataFrame) -> DataFrame:
    """One row per path: ``tree``, ``leaf``, ``conversation`` and ``loss``, the (start, end) code points of
    the texts a loss is taken over. Turns are put together in parts first, then the parts."""
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turns = rows.select(
        "tree", "leaf", F.col("up"), F.concat(head, text, F.lit(END + "\n")).alias("piece"),
        F.length(head).alias("head"), F.length(text).alias("body"), (F.col("role") == LOSS_ROLE).alias("learned"),
    )
    # Offsets inside a part come from the part's own turns, the part's from those before it.
    part = F.floor(F.col("up") / PART).cast("bigint")
    cell = F.struct((-F.col("up")).alias("at"), "piece", "head", "body", "learned", F.length("piece").alias("size"))
    parts = turns.groupBy("tree", "leaf", part.alias("part")).agg(F.array_sort(F.collect_list(cell)).alias("turns"))
    before = F.transform("turns", lambda t, i: F.aggregate(F.slice("turns", 1, i), F.lit(0), lambda n, p: n + p["size"]))
    spans = F.transform(
        F.filter(F.arrays_zip("turns", before.alias("before")), lambda z: z["turns"]["learned"]),
        lambda z: F.struct(
            (z["before"] + z["turns"]["head"]).alias("start"), (z["before"] + z["turns"]["head"] + z["turns"]["body"]).alias("end")
        ),
    )
    texts = parts.select(
        "tree", "leaf", "part", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("piece"), spans.alias("spans")
    ).withColumn("size", F.length("piece").cast("bigint"))
    sizes = running(texts.select("tree", "leaf", "part", "size"), ["tree", "leaf"], "part", {"before": ("sum", F.col("size"))}, PART, reverse=True)
    placed = texts.join(sizes.select("tree", "leaf", "part", "before"), ["tree", "leaf", "part"])
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("before")).alias("start"), (s["end"] + F.col("before")).alias("end")))
    whole = placed.groupBy("tree", "leaf").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("part")).alias("at"), "piece", moved.alias("spans")))).alias("parts")
    )
    return whole.select(
        "tree", "leaf", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("conversation"),
        F.flatten(F.transform("parts", lambda p: p["spans"])).alias("loss"),
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """``turns`` (role and text as they were) and ``learned`` (the text under the loss spans, unescaped
    span by span) of formatted conversations."""
    pieces = F.split("conversation", r"<\|im_end\|>\n")
    bare = F.transform(F.slice(pieces, 1, F.size(pieces) - 1), lambda p: F.substring(p, len(START) + 1, 2**31 - 1))

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        return F.struct(unescape(role).alias("role"), unescape(p.substr(F.length(role) + 2, F.length(p))).alias("text"))

    under = F.transform("loss", lambda s: unescape(F.col("conversation").substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return conversations.withColumn("turns", F.transform(bare, turn)).withColumn("learned", F.array_join(under, ""))


def digests(conversations: DataFrame) -> DataFrame:
    read = read_back(conversations)
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col("tree.tree").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        sha256(told).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"),
        sha256(F.col("learned")).alias("loss_sha256"),
        F.length("conversation").cast("bigint").alias("formatted_chars"),
    )
