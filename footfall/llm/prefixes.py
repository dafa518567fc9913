"""A trie of conversations, from weighted sequences and their prefixes.

Turns are numbered along each conversation and marked by a hash of role and text.
The node of a prefix is named after its depth and two 64-bit sums of the marks with
their places, so prefixes need no sorting against each other. Equal conversations are
collapsed into one sequence with a weight and the list of its ends. A sequence that is a
proper prefix of another is told by an anti-join with the parents of all nodes; what
remains are the leaves. All else are sums over the weighted prefixes of sequences.

Sums over subtrees take one row per leaf and depth: each node belongs to the leaf below
it with the least id, and so the nodes of a leaf are the lower end of its path. A running
total from the end of the path gives what the leaf adds to each of its ancestors.

Turns are numbered and totals are formed over range partitions, so one conversation may
hold any share of the rows. The digest of the ends of a sequence is sequential: its ids, 8
bytes each, stream through one task in order, with memory for one batch.

Edge cases: null role or text is empty, a null turn comes first; rows of one turn are
ordered by role, then by a hash of their text, and repeated rows are turns of their own; rows
without ``conv_id`` take no part; other columns are not read. No rows give no nodes, not even
a root. ``conv_id`` is a whole number; the remainder of a negative one is negative.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.llm.frames import map_rows
from footfall.operators.prefix import positions, running_totals
from footfall.sources.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Conversations of a block share the first turns of the block's first one.
BLOCK = 20
MOST_SHARED = 4

NODE = ["depth", "k1", "k2"]
_PARENT = ["up", "p1", "p2"]


def turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, place, mark, words)``: turns numbered from 0, texts reduced to a hash and a count."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("words"),
    )
    return stored(positions(rows, ["conv_id"], ["turn", "role", "mark"], "place").drop("turn", "role"), "turns")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and lengths of conversations whose first turns come from the first of their block.

    The first h turns are those of ``conv_id - conv_id % 20``, with h the CRC-32 of the id modulo 4;
    its own turns after the first h follow. Returns ``(conv_id, depth, mark, words)`` with depths
    from 1, and ``(conv_id, length)`` of every conversation.
    """
    shared = F.crc32(F.col("conv_id").cast("string")) % MOST_SHARED
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"))
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    heads = sizes.select(F.col("conv_id").alias("base"), F.least("n", F.lit(MOST_SHARED)).alias("has"))
    plans = sizes.withColumns({"base": base, "h": shared}).join(heads, "base", "left")
    taken = F.least("h", F.coalesce("has", F.lit(0).cast("bigint")))
    plans = stored(plans.withColumn("taken", taken), "plans")
    first = rows.where((F.col("place") < MOST_SHARED) & (F.col("conv_id") % BLOCK == 0)).withColumnRenamed("conv_id", "base")
    lent = plans.where("taken > 0").join(first, "base").where("place < taken").withColumn("depth", F.col("place") + 1)
    own = rows.join(plans.select("conv_id", "h", "taken"), "conv_id").where("place >= h")
    own = own.withColumn("depth", F.col("place") - F.col("h") + F.col("taken") + 1)
    columns = ["conv_id", "depth", "mark", "words"]
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    return lent.select(columns).unionByName(own.select(columns)), plans.select("conv_id", length.alias("length"))


def nodes_of(rows: DataFrame) -> DataFrame:
    """Each turn with the name of its node and of the parent: marks with their places, added without carry."""
    part = lambda i: F.xxhash64(F.lit(i), "depth", "mark")
    sums = {"k1": part(1), "k2": part(2), "words": F.col("words")}
    # One row a turn, so that the aggregates give its own values.
    named = running_totals(
        rows, ["conv_id"], ["depth", "mark", "words"], {k: sums[k] for k in ("k1", "k2")}, F.bit_xor, lambda x, y: x.bitwiseXOR(y)
    )
    return named.select(
        "conv_id", *NODE, "words", (F.col("depth") - 1).alias("up"),
        F.col("k1").bitwiseXOR(part(1)).alias("p1"), F.col("k2").bitwiseXOR(part(2)).alias("p2"),
    )


def _collapse(batches):
    """Runs of equal nodes in rows sorted by node and id: first id, number of ids, digest of the list."""
    last, first, n, digest = None, 0, 0, None

    def row():
        values = [*last, first, n, digest.hexdigest()]
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in values], [*NODE, "conv_id", "weight", "ends"])

    for batch in batches:
        keys = [batch.column(i).to_numpy() for i in range(3)]
        ids = batch.column(3).to_numpy()
        new = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1 if len(ids) else []
        for part in np.split(np.arange(len(ids)), new) if len(ids) else []:
            key = tuple(int(k[part[0]]) for k in keys)
            text = ",".join(map(str, ids[part].tolist())).encode()
            if key == last:
                digest.update(b"," + text)
            else:
                if last is not None:
                    yield row()
                last, first, n, digest = key, int(ids[part[0]]), 0, hashlib.sha256(text)
            n += len(part)
    if last is not None:
        yield row()


def sequences(named: DataFrame, lengths: DataFrame) -> DataFrame:
    """Equal conversations as one: node of the last turn, least ``conv_id``, ``weight``, digest of all ids."""
    last = named.join(lengths.withColumnRenamed("length", "depth"), ["conv_id", "depth"]).select(*NODE, "conv_id")
    none = F.lit(0).cast("bigint")
    silent = lengths.where("length = 0").select(none.alias("depth"), none.alias("k1"), none.alias("k2"), "conv_id")
    ends = last.select(F.col("depth").cast("bigint").alias("depth"), "k1", "k2", "conv_id").unionByName(silent)
    ordered = ends.repartition(*NODE).sortWithinPartitions(*NODE, "conv_id")
    schema = ordered.select(*NODE, "conv_id", none.alias("weight"), F.lit("").alias("ends")).schema
    return stored(map_rows(ordered, _collapse, schema), "sequences")


def trie(conversations: DataFrame) -> DataFrame:
    """Nodes of the rebuilt conversations, one row each; see the contract of ``op12_prefix_trie`` for the columns."""
    turned, lengths = rebuilt(turns(conversations))
    named = stored(nodes_of(turned), "named")
    found = sequences(named, lengths)
    none = F.lit(0).cast("bigint")
    # A sequence that is the parent of a node goes on.
    parents = named.select(*(F.col(p).alias(c) for p, c in zip(_PARENT, NODE))).distinct()
    leaves = found.join(parents, NODE, "left_anti").select("conv_id", F.lit(True).alias("leaf"))
    weights = found.select("conv_id", "weight").join(leaves, "conv_id", "left").withColumn("leaf", F.coalesce("leaf", F.lit(False)))
    weights = stored(weights, "weights")
    roots = weights.select("conv_id", *(none.alias(c) for c in (*NODE, "words")), *(F.lit(None).cast("bigint").alias(c) for c in _PARENT), "weight", "leaf")
    paths = stored(named.join(weights, "conv_id").select(roots.columns).unionByName(roots), "paths")
    nodes = stored(
        paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"),
            F.count(F.when(F.col("leaf"), 1)).alias("n_leaves"), F.min(F.when(F.col("leaf"), F.col("conv_id"))).alias("owner"),
            *(F.max(p).alias(p) for p in _PARENT),
        ),
        "nodes",
    )
    worth = nodes.select(*NODE, "owner", ((F.col("n_convs") - 1) * F.col("words")).alias("worth"))
    own = F.when(F.col("owner") == F.col("conv_id"), F.col("worth")).otherwise(0)
    steps = paths.where("leaf").select("conv_id", *NODE).join(worth, NODE).select("conv_id", *NODE, own.alias("worth"), (-F.col("depth")).alias("up"))
    steps = running_totals(steps, ["conv_id"], ["up", *NODE], {"worth": F.col("worth")})
    saved = steps.groupBy(*NODE).agg(F.sum("worth").alias("saved_tokens"))
    below = nodes.where("depth > 0").groupBy(*(F.col(p).alias(c) for p, c in zip(_PARENT, NODE))).agg(F.count("*").alias("n_children"))
    above = nodes.select(*(F.col(c).alias(p) for c, p in zip(NODE, _PARENT)), F.col("conv_id").alias("parent_conv_id"))
    whole = nodes.join(saved, NODE).join(below, NODE, "left").join(found.select(*NODE, "ends"), NODE, "left").join(above, _PARENT, "left")
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("bigint").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
