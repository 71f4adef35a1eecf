"""Reply trees to chat texts, in DataFrame functions only.

Messages are nodes with a parent. Repeated self-joins double the distance that each node looks up, which gives its depth and the
score of its path from the root; leaves are ranked by that score. The same joins, taken from the longest to the shortest, walk
from the chosen leaves to their roots and so list the nodes of every chosen path. Each path becomes one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from triagegrid.llm.common import stored

BEGIN, END = "<|turn|>", "<|end|>\n"
#: Escapes in the order they are applied; no control string, here or of another template, survives them.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), ("[", "&lsqb;")]
ROLE_ESCAPES = [*ESCAPES, ("\n", "&NewLine;")]


def escaped(text: Column, pairs=ESCAPES) -> Column:
    for raw, safe in pairs:
        text = F.replace(text, F.lit(raw), F.lit(safe))
    return text


def unescaped(text: Column, pairs=ESCAPES) -> Column:
    for raw, safe in reversed(pairs):
        text = F.replace(text, F.lit(safe), F.lit(raw))
    return text


def best_paths(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The nodes of the ``keep`` best root-to-leaf paths of each tree: conv_id, branch (1 is the best), depth (from 1), node_id.

    ``nodes`` has conv_id, node_id, parent_id and score; (conv_id, node_id) is unique. A null score counts 0; ties go to the
    smaller leaf id. A node whose parent is null or not there is a root. Nodes that only reach a cycle have no root and are on no
    path; rows without conv_id or node_id are left out.
    """
    n = nodes.filter("conv_id IS NOT NULL AND node_id IS NOT NULL").select("conv_id", "node_id", "parent_id", F.coalesce("score", F.lit(0.0)).alias("score"))
    there = n.select("conv_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("there"))
    start = n.join(there, ["conv_id", "parent_id"], "left")
    start = start.select("conv_id", "node_id", F.when(F.col("there"), F.col("parent_id")).alias("up"), F.lit(1).cast("long").alias("depth"), F.col("score").cast("double").alias("total"))
    levels = [stored(start, "level")]
    limit = max(1, levels[0].count()).bit_length() + 1
    while len(levels) <= limit and not levels[-1].filter("up IS NOT NULL").isEmpty():
        # a level holds what was open in the one before; who has met its root is looked up but not joined again
        known = levels[-1]
        for level in levels[:-1]:
            known = known.union(level.filter("up IS NULL"))
        above = known.select("conv_id", F.col("node_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("total").alias("added"))
        step = levels[-1].filter("up IS NOT NULL").join(above, ["conv_id", "up"]).select(
            "conv_id", "node_id", F.col("next").alias("up"),
            (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("added")).alias("total"),
        )
        levels.append(stored(step, "level"))
    rooted = levels[0].filter("up IS NULL")
    for level in levels[1:]:
        rooted = rooted.union(level.filter("up IS NULL"))
    inner = levels[0].filter("up IS NOT NULL").select("conv_id", F.col("up").alias("node_id")).distinct()
    order = Window.partitionBy("conv_id").orderBy(F.desc("total"), "node_id")
    leaves = rooted.join(inner, ["conv_id", "node_id"], "left_anti").withColumn("branch", F.row_number().over(order)).filter(F.col("branch") <= keep)
    path = stored(leaves.select("conv_id", "branch", "node_id"), "path")
    for level in reversed(levels[:-1]):
        up = level.filter("up IS NOT NULL").select("conv_id", "node_id", "up")
        path = stored(path.union(path.join(up, ["conv_id", "node_id"]).select("conv_id", "branch", F.col("up").alias("node_id"))), "path")
    return path.join(rooted.select("conv_id", "node_id", "depth"), ["conv_id", "node_id"]).select("conv_id", "branch", "depth", "node_id")


def formatted(turns: DataFrame) -> DataFrame:
    """One text for each (conv_id, branch) of ``turns`` (conv_id, branch, depth, role, text): formatted, mask.

    A turn is ``BEGIN role newline text END``, with control strings in role and text escaped. The mask lists the code point
    ranges of the assistant's texts. Null roles and texts are empty.
    """
    t = turns.select("conv_id", "branch", "depth", F.coalesce("role", F.lit("")).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("body"))
    head = F.concat(F.lit(BEGIN), escaped(F.col("role"), ROLE_ESCAPES), F.lit("\n"))
    t = t.withColumn("head", head).withColumn("piece", F.concat("head", "body", F.lit(END)))
    upto = Window.partitionBy("conv_id", "branch").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("start", F.sum(F.length("piece").cast("long")).over(upto) - F.length("piece") + F.length("head"))
    said = F.when(F.col("role") == "assistant", F.struct(F.col("start"), (F.col("start") + F.length("body")).alias("end")))
    grouped = t.groupBy("conv_id", "branch").agg(
        F.sort_array(F.collect_list(F.struct("depth", "piece"))).alias("pieces"), F.sort_array(F.collect_list(said)).alias("mask")
    )
    return grouped.select("conv_id", "branch", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"), "mask")


def read_back(texts: DataFrame) -> DataFrame:
    """Adds what a reader of the formatted text finds: turns (role, text) and loss_text, both unescaped."""
    pieces = F.split("formatted", r"<\|end\|>\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    role = lambda p: unescaped(F.substring_index(F.substr(p, F.lit(len(BEGIN) + 1)), "\n", 1), ROLE_ESCAPES)
    body = lambda p: unescaped(F.substr(p, F.locate("\n", p) + 1))
    turns = F.transform(pieces, lambda p: F.struct(role(p).alias("role"), body(p).alias("text")))
    cut = F.transform("mask", lambda m: F.substr(F.col("formatted"), (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))
    return texts.withColumn("turns", turns).withColumn("loss_text", F.array_join(F.transform(cut, lambda x: unescaped(x)), ""))


def linear_trees(conversations: DataFrame) -> DataFrame:
    """Rows ordered by turn (nulls first, then role and text) as trees in which each message answers the one before.

    Rows without conv_id belong to no conversation and are left out; repeated rows are turns of their own.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    at = F.row_number().over(order).cast("long")
    return rows.select("conv_id", at.alias("node_id"), (at - 1).alias("parent_id"), F.lit(0.0).alias("score"), "role", "text")


def chat_texts(nodes: DataFrame, keep: int = 1) -> DataFrame:
    """The chosen paths of reply trees (conv_id, node_id, parent_id, score, role, text) as texts with their loss masks.

    No nodes give no texts. A conversation is one text, however long its messages. Other columns are not looked at.
    """
    nodes = stored(nodes, "nodes")
    path = best_paths(nodes, keep)
    return formatted(path.join(nodes.select("conv_id", "node_id", "role", "text"), ["conv_id", "node_id"]))
