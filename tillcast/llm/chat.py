"""Reply trees to chat text.

A tree's nodes name their parents. Iterative self-joins double the step from a node to an ancestor until
every node has reached its root, adding up scores and lengths on the way; a leaf's path is ranked by
its mean score, the best ``top`` paths of every tree are chosen, and a second round of joins, from long
steps to short, takes the chosen paths apart into their nodes. A path of n nodes takes 2 log2(n) joins.
Each path is then written as one conversation. Built with DataFrame functions only.

Template: every turn is ``<s>[INST]role[/INST]text</s>``. Inside roles and texts a backslash is doubled,
and one is put after the first character of anything that looks like a mark, so marks never occur
there and reading back gives the same strings. The loss covers the texts of the assistant.

Defined cases: a null role or text is empty; a parent that isn't in the table makes its child a root;
ties in score go to the smaller leaf; an empty table gives an empty result; nodes whose ancestors run in
a circle are an error, as they have no root. Node ids must be unique within a tree: rows of a linear
conversation that share a turn are numbered by role and text.

A conversation becomes one string, so its turns meet in one task at the end; everything before works on
single nodes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.session import settled

# The marks of the template.
BEGIN, END, ROLE_BEGIN, ROLE_END = "<s>", "</s>", "[INST]", "[/INST]"
MARK = r"([<\[])(/?(?:s>|INST\]))"
ASSISTANT = "assistant"


def escaped(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, MARK, r"$1\\$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linear(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees of one branch."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("long")
    return turns.select(
        F.col("conv_id").alias("tree"),
        node.alias("node"),
        F.when(node > 1, node - 1).alias("parent"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def chosen_paths(nodes: DataFrame, top: int) -> DataFrame:
    """(tree, leaf, node, place) of every node on the ``top`` best paths of each tree.

    ``nodes`` has tree, node, parent and score. A node on several chosen paths occurs in each.
    """
    nodes = settled(nodes.select("tree", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")))
    known = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    there = nodes["tree"].eqNullSafe(known["t"]) & (nodes["parent"] == known["p"])
    steps = settled(
        nodes.join(known, there, "left").select(
            "tree", "node", F.col("p").alias("up"), F.lit(1).cast("long").alias("n"), F.col("score").alias("total")
        )
    )
    parents = steps.where("up IS NOT NULL").select(
        F.col("tree").alias("t"), F.col("up").alias("p")
    ).distinct()
    childless = steps["tree"].eqNullSafe(parents["t"]) & (steps["node"] == parents["p"])
    leaves = settled(steps.join(parents, childless, "left_anti").select("tree", "node"))
    levels = [steps]
    most = nodes.count().bit_length() + 1
    while not steps.where("up IS NOT NULL").isEmpty():
        if len(levels) > most:
            raise ValueError("some nodes are their own ancestors")
        far = steps.select(
            F.col("tree").alias("t"),
            F.col("node").alias("p"),
            F.col("up").alias("up_2"),
            F.col("n").alias("n_2"),
            F.col("total").alias("total_2"),
        )
        joined = steps.join(far, steps["tree"].eqNullSafe(far["t"]) & (steps["up"] == far["p"]), "left")
        steps = settled(
            joined.select(
                "tree",
                "node",
                F.col("up_2").alias("up"),
                (F.col("n") + F.coalesce("n_2", F.lit(0))).alias("n"),
                (F.col("total") + F.coalesce("total_2", F.lit(0.0))).alias("total"),
            )
        )
        levels.append(steps)
    ends = steps.drop("up").withColumnRenamed("tree", "t").withColumnRenamed("node", "p")
    ranked = leaves.join(ends, leaves["tree"].eqNullSafe(ends["t"]) & (leaves["node"] == ends["p"]))
    best = Window.partitionBy("tree").orderBy((F.col("total") / F.col("n")).desc(), "node")
    paths = settled(
        ranked.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("tree", F.col("node").alias("leaf"), "node", F.col("n").alias("length"), F.col("n").alias("place"))
    )
    for k in reversed(range(len(levels) - 1)):
        far = levels[k].select(F.col("tree").alias("t"), F.col("node").alias("p"), "up")
        long = F.col("length") > 2**k
        lower = paths.withColumn("length", F.least("length", F.lit(2**k).cast("long")))
        upper = (
            paths.where(long)
            .join(far, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")))
            .select(
                "tree",
                "leaf",
                F.col("up").alias("node"),
                (F.col("length") - 2**k).alias("length"),
                (F.col("place") - 2**k).alias("place"),
            )
        )
        paths = settled(lower.unionByName(upper))
    return paths.select("tree", "leaf", "node", "place")


def formatted(nodes: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, chat, loss): one conversation per chosen path.

    ``loss`` has a span of code points (start, end) for every turn, empty unless it is the assistant's.
    """
    paths = chosen_paths(nodes, top).withColumnRenamed("tree", "t").withColumnRenamed("node", "p")
    texts = nodes.select("tree", "node", "role", "text")
    turns = paths.join(texts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("node") == F.col("p")))
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(BEGIN + ROLE_BEGIN), escaped(role), F.lit(ROLE_END))
    turns = turns.select(
        "tree", "leaf", "place", role.alias("role"), head.alias("head"), escaped(text).alias("body")
    )
    upto = Window.partitionBy("tree", "leaf").orderBy("place")
    size = F.length("head") + F.length("body") + len(END)
    end = F.sum(size).over(upto.rowsBetween(Window.unboundedPreceding, 0)) - len(END)
    start = end - F.when(F.col("role") == ASSISTANT, F.length("body")).otherwise(0)
    turn = F.struct(
        "place",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        F.struct(start.alias("start"), end.alias("end")).alias("span"),
    )
    ordered = F.array_sort(F.collect_list("turn"))
    return (
        turns.select("tree", "leaf", turn.alias("turn"))
        .groupBy("tree", "leaf")
        .agg(ordered.alias("turns"))
        .select(
            "tree",
            "leaf",
            F.array_join(F.col("turns.piece"), "").alias("chat"),
            F.col("turns.span").alias("loss"),
        )
    )


def read_back(chats: DataFrame) -> DataFrame:
    """(tree, leaf, place, role, text, learned): the turns of formatted conversations.

    ``learned`` is the text under the loss spans of the turn.
    """
    pieces = F.split("chat", END, -1)
    parts = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(pieces) - 1).alias("piece"), F.col("loss").alias("span"))
    rows = chats.select("tree", "leaf", F.posexplode(parts).alias("place", "part")).select(
        "tree", "leaf", "place", "part.piece", "part.span"
    )
    upto = Window.partitionBy("tree", "leaf").orderBy("place")
    size = F.length("piece") + len(END)
    offset = F.sum(size).over(upto.rowsBetween(Window.unboundedPreceding, 0)) - size
    inner = F.substr(F.col("piece"), F.lit(len(BEGIN + ROLE_BEGIN) + 1))
    role = F.substring_index(inner, ROLE_END, 1)
    text = F.substr(inner, F.length(role) + len(ROLE_END) + 1)
    begin, end = F.col("span.start") - F.col("offset"), F.col("span.end") - F.col("offset")
    return rows.withColumn("offset", offset).select(
        "tree",
        "leaf",
        "place",
        unescaped(role).alias("role"),
        unescaped(text).alias("text"),
        unescaped(F.col("piece").substr((begin + 1).cast("int"), (end - begin).cast("int"))).alias("learned"),
    )


def joined(column: str) -> Column:
    """The strings of a group's turns in their order, one after the other."""
    turns = F.array_sort(F.collect_list(F.struct("place", column)))
    return F.array_join(F.transform(turns, lambda turn: turn[column]), "")
