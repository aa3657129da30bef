"""Conversations out of reply trees: paths from the root to each leaf, ranked, and formatted as one text.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings of this and of common other templates
inside texts and roles get a backslash after their first character, one more for each backslash already
there, which :func:`unescaped` takes back; in roles backslashes are doubled and a line feed is written
``\\n``. So a text never contains a mark, and every formatted conversation reads back as what went in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import written

BEGIN, END = "<|im_start|>", "<|im_end|>"
_CONTROL = r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|/?s>|/?INST\]|/?SYS>>)"
_PLAIN, _ESCAPED = rf"([<\[])(\\*){_CONTROL}", rf"([<\[])\\(\\*){_CONTROL}"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, _PLAIN, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    """Undo ``_role_out``: doubled backslashes are set aside, so that only real line feeds are turned back."""
    parts = F.split(unescaped(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def branches(messages: DataFrame) -> DataFrame:
    """``tree, leaf, node, up`` for every node on the way from each leaf to its root, ``up`` steps above the leaf.

    ``messages`` has ``tree, node, parent``; a null parent, or one that is not there, makes a root. Each
    self-join doubles the steps that a pointer spans, so their number is the logarithm of the depth.
    A leaf whose way up runs into a circle has no path.
    """
    nodes = messages.select("tree", "node", "parent")
    there = nodes.select("tree", F.col("node").alias("parent"), F.col("node").alias("up")).distinct()
    nodes = written(nodes.join(there, ["tree", "parent"], "left").select("tree", "node", "up"), "nodes")
    parents = nodes.select("tree", F.col("up").alias("node")).filter("node is not null").distinct()
    leaves = nodes.join(parents, ["tree", "node"], "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("steps"))
    jumps, span, size = nodes.filter("up is not null"), 1, nodes.count()
    while span <= size and not jumps.isEmpty():
        further = paths.join(jumps, ["tree", "node"])
        further = further.select("tree", "leaf", F.col("up").alias("node"), (F.col("steps") + span).alias("steps"))
        paths = written(paths.unionByName(further), "paths")
        onward = jumps.select("tree", F.col("node").alias("up"), F.col("up").alias("next"))
        jumps = written(jumps.join(onward, ["tree", "up"]).select("tree", "node", F.col("next").alias("up")), "jumps")
        span *= 2
    roots = nodes.filter("up is null").select("tree", "node")
    complete = paths.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf")
    return paths.join(complete, ["tree", "leaf"], "left_semi").withColumnRenamed("steps", "up")


def conversations(messages: DataFrame, best: int = 1) -> DataFrame:
    """``tree, leaf, rank, score, formatted, loss`` for the ``best`` branches of every tree.

    ``messages`` has ``tree, node, parent, role, text, score``, nodes unique within their tree. A branch scores the sum of
    its nodes (null: 0); the higher comes first, ties go to the lesser leaf. Null texts and roles count as
    empty; a null tree is a tree like any other; rows with a null node are left out. ``loss`` has
    ``start`` and ``size``, in characters of ``formatted``, of every assistant text in order.
    """
    names = messages.columns
    messages = messages.filter("node is not null").withColumn("tree", F.struct("tree"))
    paths = written(branches(messages), "branches")
    turns = messages.select(
        "tree",
        "node",
        F.coalesce("role", F.lit("")).alias("role"),
        escaped(F.coalesce("text", F.lit(""))).alias("text"),
        (F.coalesce("score", F.lit(0.0)) if "score" in names else F.lit(0.0)).alias("score"),
    )
    scores = paths.join(turns.select("tree", "node", "score"), ["tree", "node"])
    scores = scores.groupBy("tree", "leaf").agg(F.sum("score").alias("score"))
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    # One conversation is one row, so its turns come together; they are put in order there.
    whole = paths.join(chosen, ["tree", "leaf"]).join(turns.drop("score"), ["tree", "node"])
    whole = whole.groupBy("tree", "leaf", "rank", "score").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns")
    )
    heads = F.transform("turns", lambda t: F.concat(F.lit(BEGIN), _role_out(t["role"]), F.lit("\n")))
    whole = whole.withColumn("heads", heads).withColumn(
        "sizes", F.zip_with("heads", "turns", lambda h, t: F.length(h) + F.length(t["text"]) + len(END) + 1)
    )
    # Where each turn begins, by one pass over the sizes.
    zero = F.struct(F.lit(0).cast("bigint").alias("next"), F.array().cast("array<bigint>").alias("starts"))
    added = F.aggregate(
        "sizes",
        zero,
        lambda s, n: F.struct((s["next"] + n).alias("next"), F.concat(s["starts"], F.array(s["next"])).alias("starts")),
    )
    spans = F.transform(
        F.arrays_zip("turns", "heads", added["starts"].alias("starts")),
        lambda x: F.struct(
            x["turns"]["role"].alias("role"), (x["starts"] + F.length(x["heads"])).alias("start"), F.length(x["turns"]["text"]).alias("size")
        ),
    )
    spoken = F.filter(spans, lambda s: s["role"] == "assistant")
    loss = F.transform(spoken, lambda s: F.struct(s["start"].alias("start"), s["size"].alias("size")))
    text = F.array_join(F.zip_with("heads", "turns", lambda h, t: F.concat(h, t["text"], F.lit(END + "\n"))), "")
    return whole.select(F.col("tree")["tree"].alias("tree"), "leaf", "rank", "score", text.alias("formatted"), loss.alias("loss"))


def parsed(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``role, text``."""
    bodies = F.split(formatted, r"<\|im_end\|>\n", -1)
    bodies = F.slice(bodies, 1, F.size(bodies) - 1)

    def turn(body: Column) -> Column:
        at = F.position(F.lit("\n"), body)
        role = F.substring(body, F.lit(len(BEGIN) + 1), at - 1 - len(BEGIN))
        return F.struct(_role_in(role).alias("role"), unescaped(F.substring(body, at + 1, F.length(body))).alias("text"))

    return F.transform(bodies, turn)


def under_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["size"]))), ""
    )
