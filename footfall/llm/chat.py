"""Reply trees to training conversations, on DataFrame functions alone.

Nodes of a tree are messages with a parent. Pointer doubling, an iterated
self-join, finds the root, depth and branch score of every node and a table of
its 2^k-th ancestors; the same table, read from the longest jump down, lists the
path of every chosen leaf. Branches are ranked by the sum of the scores on them.

Template of one message: ``### role: text</turn>`` and a line end. In texts and
roles the characters that control strings are made of are replaced: backslash by
``\\s``, ``<`` by ``\\l``, ``#`` by ``\\h`` and, in roles, ``:`` by ``\\c``. So neither
``<`` nor ``#`` is left inside a text and reading back is exact.

Edge cases: null texts and roles are empty; rows of one turn are ordered by role,
then text; equal rows are messages of their own; a null conversation id is one
conversation; a parent that does not exist makes a root; no rows give no rows.
Branches take one row a node; where ids repeat, ``format_trees`` tells the rows apart.
A node on a circle of parents has no root and is left out. Extra columns are
ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from footfall.sources.scratch import stored

LEARNED_ROLE = "assistant"
#: Escapes, in the order in which they are applied; undone in the opposite order.
ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("#", "\\h"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
MESSAGE = r"### ([^:<#]*): ([^<#]*)</turn>\n"


def escape(text: Column, escapes=ESCAPES) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), escapes, text)


def unescape(text: Column, escapes=ESCAPES) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), reversed(escapes), text)


def linear_nodes(rows: DataFrame) -> DataFrame:
    """Conversations of turns as trees without branches: each turn replies to the one before.

    A conversation becomes one string in the end, so its turns are numbered together.
    """
    rows = rows.select(
        "conv_id", "turn", *(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("role", "text"))
    )
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    rows = rows.withColumn("node", place.cast("bigint"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return rows.select("conv_id", "node", parent.alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def told_apart(nodes: DataFrame) -> DataFrame:
    """Trees whose node ids may repeat, with ids ``(node, copy)`` that name one row each.

    Rows of one id are numbered by parent, role, text and score. Replies hang on the first
    of them, copy 0; the others have no replies and end branches of their own.
    """
    order = [F.col("parent").asc_nulls_first(), "role", "text", "score"]
    copy = F.row_number().over(Window.partitionBy("conv_id", "node").orderBy(*order)) - 1
    parent = F.when(F.col("parent").isNotNull(), F.struct(F.col("parent").alias("node"), F.lit(0).alias("copy")))
    rows = nodes.withColumn("_copy", copy)
    return rows.select("conv_id", F.struct("node", F.col("_copy").alias("copy")).alias("node"), parent.alias("parent"), "role", "text", "score")


def format_trees(nodes: DataFrame, best: int | None = None, learned: str = LEARNED_ROLE) -> DataFrame:
    """``format_branches`` for nodes whose ids may repeat: ``leaf`` and its ``copy`` name a branch."""
    found = format_branches(told_apart(nodes), best, learned)
    return found.select("conv_id", "leaf.node", "leaf.copy", "rank", "formatted", "loss").withColumnRenamed("node", "leaf")


def ancestors(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Jump tables and branch figures of all nodes.

    Table k has ``(conv_id, node, up)``, the 2^k-th ancestor where there is one.
    The other frame has ``(conv_id, node, root, depth, total)``. The number of
    joins is the logarithm of the deepest tree's depth.
    """
    key = ("conv_id", "node")
    # A conversation may have a null id, and joins on null need to be told.
    named = nodes.select(*key, "parent", "score")
    exist = named.select(F.col("conv_id").alias("c"), F.col("node").alias("n"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("n"))
    known = named.join(exist, same, "left").select(
        *key, F.col("n").alias("up"), F.lit(1).cast("bigint").alias("depth"), F.col("score").alias("total"), F.col("node").alias("root")
    )
    state = stored(known, "chat-jumps")
    tables = []
    # No path is longer than there are nodes: what is open after that is a circle.
    most = nodes.count().bit_length()
    while True:
        open_ = state.where(F.col("up").isNotNull())
        if len(tables) >= most or open_.isEmpty():
            break
        tables.append(open_.select(*key, "up"))
        above = state.select(
            F.col("conv_id").alias("c"), F.col("node").alias("n"), F.col("up").alias("up2"),
            F.col("depth").alias("depth2"), F.col("total").alias("total2"), F.col("root").alias("root2"),
        )
        hit = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("up") == F.col("n"))
        # Nodes that have reached their root stay as they are and are not joined again.
        longer = open_.join(above, hit, "left")
        done = state.where(F.col("up").isNull())
        state = stored(
            longer.select(
                *key,
                F.col("up2").alias("up"),
                (F.col("depth") + F.coalesce("depth2", F.lit(0))).alias("depth"),
                (F.col("total") + F.coalesce("total2", F.lit(0.0))).alias("total"),
                F.coalesce("root2", "root").alias("root"),
            ).unionByName(done),
            "chat-jumps",
        )
    return tables, state.where(F.col("up").isNull()).drop("up")


def branches(nodes: DataFrame, best: int | None = None) -> DataFrame:
    """``(conv_id, leaf, rank, node, step)``: the nodes of the ``best`` branches of each tree, root first.

    A branch runs from a root to a leaf. Rank 1 has the greatest total score,
    then the greater depth, then the smaller leaf.
    """
    tables, figures = ancestors(nodes)
    parents = nodes.select(F.col("conv_id").alias("c"), F.col("parent").alias("p")).where("p IS NOT NULL").distinct()
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("p"))
    leaves = figures.join(parents, same, "left_anti")
    order = Window.partitionBy("conv_id", "root").orderBy(F.desc("total"), F.desc("depth"), "node")
    leaves = leaves.withColumn("rank", F.row_number().over(order))
    if best is not None:
        leaves = leaves.where(F.col("rank") <= best)
    path = leaves.select("conv_id", F.col("node").alias("leaf"), "rank", "node", F.col("depth").alias("step"))
    # Every distance is one sum of powers of two, so each ancestor is reached once.
    for k in reversed(range(len(tables))):
        jump = tables[k].select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "up")
        hit = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
        moved = path.join(jump, hit).select(
            "conv_id", "leaf", "rank", F.col("up").alias("node"), (F.col("step") - (1 << k)).alias("step")
        )
        path = path.unionByName(moved)
        if k % 4 == 0:
            path = stored(path, "chat-paths")
    return path


def format_branches(nodes: DataFrame, best: int | None = None, learned: str = LEARNED_ROLE) -> DataFrame:
    """``(conv_id, leaf, rank, formatted, loss)`` of each chosen branch.

    ``loss`` are the spans of ``formatted`` to learn from, as first code point
    and length: the escaped texts of messages whose role is ``learned``.
    """
    nodes = stored(nodes, "chat-nodes")
    path = branches(nodes, best)
    said = nodes.select(F.col("conv_id").alias("c"), F.col("node").alias("n"), "role", "text")
    hit = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n"))
    head = F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    body = escape(F.col("text"))
    message = F.struct(
        "step", F.concat(head, body, F.lit("</turn>\n")).alias("message"), F.length(head).cast("bigint").alias("head"),
        F.length(body).cast("bigint").alias("body"), (F.col("role") == learned).alias("learned"),
    )
    grouped = (
        path.join(said, hit)
        .groupBy("conv_id", "leaf", "rank")
        .agg(F.sort_array(F.collect_list(message)).alias("m"))
    )
    # Running offset and the spans so far, message by message.
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,size:bigint>>").alias("spans"))

    def step(state, m):
        span = F.struct((state["at"] + m["head"]).alias("start"), m["body"].alias("size"))
        spans = F.when(m["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(m["message"])).alias("at"), spans.alias("spans"))

    spans = F.aggregate("m", start, step)["spans"]
    text = F.array_join(F.transform("m", lambda m: m["message"]), "")
    return grouped.select("conv_id", "leaf", "rank", text.alias("formatted"), spans.alias("loss"))


def read_messages(formatted: Column) -> Column:
    """Messages of a formatted conversation, as ``role`` and ``text``, unescaped."""
    whole = F.regexp_extract_all(formatted, F.lit(MESSAGE), F.lit(0))
    role = lambda m: unescape(F.regexp_extract(m, MESSAGE, 1), ROLE_ESCAPES)
    text = lambda m: unescape(F.regexp_extract(m, MESSAGE, 2))
    return F.transform(whole, lambda m: F.struct(role(m).alias("role"), text(m).alias("text")))


def read_learned(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    piece = lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["size"].cast("int")))
    return F.array_join(F.transform(loss, piece), "")
