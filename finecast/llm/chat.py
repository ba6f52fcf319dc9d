"""Conversations from reply trees: paths by joins, branches by score, one formatted text each."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finecast.llm.shared import present, written

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLES = ("assistant",)
_TURN = re.compile(re.escape(START) + "([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.S)


def escape(text: str) -> str:
    """No control string can remain: every ``<|`` is broken up, and the mark used for that is doubled."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S) if "\\" in text else text


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted conversation and the spans (code points) that the loss counts."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        if role in LOSS_ROLES:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(out), spans


def read_back(formatted: str, spans: list[tuple[int, int]]) -> tuple[list[tuple[str, str]], str]:
    """Turns and the text under the loss mask, from the output alone."""
    turns = [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]
    return turns, "".join(unescape(formatted[s:e]) for s, e in spans)


def tree_paths(nodes: DataFrame) -> DataFrame:
    """(conv, leaf, node, back) for every root-to-leaf path of (conv, node, parent); ``back`` counts steps up from the leaf.

    Self-joins with doubled steps: round k knows each node's ancestor 2^k steps
    up and adds to each leaf the ancestors 2^k further on, so a tree of depth d
    takes log2(d) rounds and the rows are those of the result.  A parent that is
    not there counts as none; nodes on a cycle have no leaf and no path.
    """
    here = nodes.select("conv", F.col("node").alias("parent"))
    up = nodes.join(here, ["conv", "parent"], "left_semi").select("conv", "node", F.col("parent").alias("anc"))
    up = written(up, "steps")
    parents = up.select("conv", F.col("anc").alias("node")).distinct()
    paths = nodes.select("conv", "node").distinct().join(parents, ["conv", "node"], "left_anti").select("conv", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back"))
    paths = written(paths, "paths")
    step = 1
    while True:
        more = written(paths.join(up, ["conv", "node"]).select("conv", "leaf", F.col("anc").alias("node"), (F.col("back") + step).alias("back")), "paths")
        if more.isEmpty():
            return paths
        paths = paths.union(more)
        up = written(up.join(up.select("conv", F.col("node").alias("anc"), F.col("anc").alias("above")), ["conv", "anc"]).select("conv", "node", F.col("above").alias("anc")), "steps")
        step *= 2


def best_paths(paths: DataFrame, scores: DataFrame, top: int = 1) -> DataFrame:
    """Paths of each conversation's ``top`` branches by mean score (conv, node, score), then by most turns, then by leaf.

    The rank limit is applied within each task before the shuffle, so a
    conversation with very many branches does not meet in one task.
    """
    branch = paths.join(scores, ["conv", "node"]).groupBy("conv", "leaf").agg(F.avg("score").alias("score"), F.count("*").alias("turns"))
    order = Window.partitionBy("conv").orderBy(F.desc("score"), F.desc("turns"), "leaf")
    chosen = branch.withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= top)
    return paths.join(chosen.select("conv", "leaf", "branch", F.col("score").alias("branch_score")), ["conv", "leaf"])


_FORMATTED = T.StructType([T.StructField("formatted", T.StringType()), T.StructField("loss", T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())])))])


@F.pandas_udf(_FORMATTED)
def _rendered(turns: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([render([(t["role"], t["text"]) for t in row]) for row in turns], columns=["formatted", "loss"])


def format_trees(messages: DataFrame, top: int = 1) -> DataFrame:
    """(conv_id, branch, branch_score, n_turns, formatted, loss) from (conv_id, node, parent, role, text, score).

    Null role and text count as empty; a null conv_id is a conversation of its
    own; a null score counts as 0.  Messages that repeat (conv_id, node) are one
    node: the smallest (parent, role, text) stays.  A conversation's messages
    meet only as its formatted text, which is one value.
    """
    rows = messages.select(
        F.col("conv_id").alias("id"), F.coalesce(F.col("conv_id").cast("string"), F.lit("\0")).alias("conv"), "node", "parent",
        F.struct(present(F.col("role")).alias("role"), present(F.col("text")).alias("text")).alias("turn"), F.coalesce("score", F.lit(0)).cast("double").alias("score"),
    )
    rows = rows.where("node IS NOT NULL").groupBy("conv", "node").agg(F.min(F.struct(F.col("parent"), "turn", "score", "id")).alias("r")).select("conv", "node", "r.*")
    rows = written(rows, "messages")
    chosen = best_paths(tree_paths(rows.select("conv", "node", "parent")), rows.select("conv", "node", "score"), top)
    held = chosen.join(rows.select("conv", "node", "turn", "id"), ["conv", "node"])
    grouped = held.groupBy("conv", "branch").agg(
        F.first("id").alias("conv_id"), F.first("branch_score").alias("branch_score"), F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("o"), "turn"))).alias("all")
    )
    done = grouped.withColumn("turns", F.expr("transform(all, x -> x.turn)")).withColumn("f", _rendered("turns"))
    return done.select("conv_id", "branch", "branch_score", F.size("turns").cast("long").alias("n_turns"), "f.formatted", "f.loss")


def from_turns(conversations: DataFrame) -> DataFrame:
    """Messages of (conv_id, turn, role, text): each row answers the one before it in its conversation.

    Rows of one turn follow by role and text, repeated rows one after the other;
    a null turn comes first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.length(present(F.col("text"))))


_DIGEST = T.StructType(
    [T.StructField("n_turns", T.LongType()), T.StructField("turns", T.StringType()), T.StructField("loss", T.StringType())]
)


@F.pandas_udf(_DIGEST)
def _read(formatted: pd.Series, loss: pd.Series) -> pd.DataFrame:
    out = []
    for text, spans in zip(formatted, loss, strict=True):
        turns, under = read_back(text, [(int(x["s"]), int(x["e"])) for x in spans])
        out.append((len(turns), "".join(f"{r}\n{t}\n" for r, t in turns), under))
    return pd.DataFrame(out, columns=["n_turns", "turns", "loss"])


def chat_report(conversations: DataFrame) -> DataFrame:
    """Digest of every formatted conversation, read back from the output."""
    d = format_trees(from_turns(conversations)).withColumn("d", _read("formatted", "loss"))
    return d.select(
        "conv_id", F.col("d.n_turns").alias("n_turns"), F.sha2(F.col("d.turns").cast("binary"), 256).alias("turns_sha256"),
        F.length("d.loss").cast("long").alias("loss_chars"), F.sha2(F.col("d.loss").cast("binary"), 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )
