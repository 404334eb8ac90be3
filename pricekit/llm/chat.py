"""Chat formatting of reply trees.

Messages form trees by their parents. Root-to-leaf paths are enumerated by
iterative self-joins: every leaf's ancestors at a distance below 2**k are
joined with the jump of 2**k steps, so the number of joins grows with the
logarithm of the depth. Branches of a tree are ranked by the mean score of
their messages, and each chosen path becomes one conversation in a template
that marks turns. Control strings inside roles and texts are escaped, and
the escape is reversible: a backslash more between ``<`` and ``|``.

Cases: a null role or text counts as empty; a null score counts as 0; a
message whose parent does not exist is a root; messages without an id, or in
a cycle, belong to no path from a root and are left out; equal scores rank by
the leaf's id; an empty table gives an empty result; other columns, whatever their
names, are not read. Ids must be unique; ``linear_messages`` makes such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricekit.llm._stage import staged

# The template's control strings.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "\n"
MAX_STEPS = 40


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def linear_messages(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Tables of turns as trees: each turn replies to the one before. Rows of one turn go by role, then text.

    ``id`` is a struct of the conversation and the place in it; a null conversation is one like others.
    """
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    placed = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                         F.col(role_col).alias("role"), F.col(text_col).alias("text")).withColumn("n", F.row_number().over(order))
    return placed.select(F.struct("conv", "n").alias("id"),
                         F.when(F.col("n") > 1, F.struct("conv", (F.col("n") - 1).alias("n"))).alias("parent"),
                         "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """``(leaf, node, up)``: for each leaf, the nodes on the path to its root and their distance."""
    links = staged(messages.filter(F.col("id").isNotNull()).select("id", "parent"), "links")
    real = links.filter(F.col("parent").isNotNull()).join(links.select(F.col("id").alias("parent")), "parent", "left_semi")
    jump = staged(real.select("id", F.col("parent").alias("to")), "jump")
    leaves = links.select("id").join(jump.select(F.col("to").alias("id")).distinct(), "id", "left_anti")
    found = staged(leaves.select(F.col("id").alias("leaf"), F.col("id").alias("node"), F.lit(0).alias("up")), "paths")
    size, step = found.count(), 0
    while not jump.isEmpty():
        if step >= MAX_STEPS:
            raise ValueError("messages reply to each other in a cycle that has a branch")
        further = found.join(jump, found["node"] == jump["id"]).select("leaf", F.col("to").alias("node"), (F.col("up") + (1 << step)).alias("up"))
        found = staged(found.union(further), "paths")
        grown = found.count()
        if grown == size:
            break
        size, step = grown, step + 1
        jump = staged(jump.join(jump.select(F.col("id").alias("to"), F.col("to").alias("far")), "to")
                      .select("id", F.col("far").alias("to")), "jump")
    return found


def format_conversations(messages: DataFrame, best: int | None = None, learn: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(root, leaf, rank, score, formatted, loss)`` of all root-to-leaf paths, or the ``best`` of each tree.

    ``messages``: ``(id, parent, role, text, score)``. ``loss``: array of
    ``(start, end)`` in code points of ``formatted``, the texts of the roles in ``learn``.
    """
    kept = messages.select("id", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
                           F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(NEWLINE))
    body = escape(F.col("text"))
    turns = kept.select("id", "score", head.alias("head"), body.alias("body"), F.col("role").isin(*learn).alias("learn"))
    route = paths(kept)
    if best is not None:
        # only ids and scores are shuffled to rank; texts join the chosen paths
        scored = route.join(turns.select(F.col("id").alias("node"), "score"), "node")
        ranked = _ranked(scored.groupBy("leaf").agg(F.mean("score").alias("score"), F.max_by("node", "up").alias("root")))
        route = route.join(ranked.filter(F.col("rank") <= best).select("leaf"), "leaf", "left_semi")
    tail = END + NEWLINE
    size = (F.length("head") + F.length("body") + len(tail)).cast("bigint")
    before = Window.partitionBy("leaf").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    placed = route.join(turns.withColumnRenamed("id", "node"), "node").withColumn("start", F.coalesce(F.sum(size).over(before), F.lit(0)))
    whole = placed.groupBy("leaf").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "head", "body", "learn", "start"))).alias("t"),
        F.mean("score").alias("score"), F.max_by("node", "up").alias("root"))
    formatted = F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "")
    text = F.transform(F.filter("t", lambda x: x["learn"]), lambda x: F.struct(
        (x["start"] + F.length(x["head"])).alias("start"), (x["start"] + F.length(x["head"]) + F.length(x["body"])).alias("end")))
    return _ranked(whole.select("root", "leaf", "score", formatted.alias("formatted"), text.alias("loss"))).select(
        "root", "leaf", "rank", "score", "formatted", "loss")


def _ranked(df: DataFrame) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("score"), "leaf")))


def read_back(formatted: Column) -> Column:
    """The turns ``(role, text)`` of a formatted conversation, unescaped."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(turns, lambda x: F.struct(
        unescape(F.regexp_extract(x, r"(?s)^<\|im_start\|>(.*?)\n", 1)).alias("role"),
        unescape(F.regexp_extract(x, r"(?s)^<\|im_start\|>.*?\n(.*)$", 1)).alias("text")))


def under_mask(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped: the masked texts one after the other."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")
