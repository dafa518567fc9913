"""Connected components of a graph given as pairs of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.sources.scratch import stored

#: Pairs that ``forest`` holds at a time.
HELD = 1 << 20


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and two sums over them: equal only if nothing changed."""
    mark = F.xxhash64("u", "v")
    row = edges.agg(F.count("*"), F.sum(mark % 1000003), F.sum(F.shiftright(mark, 32) % 999983)).first()
    return tuple(row)


def components(pairs: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``(a, b)``; a component is named after its least id.

    Large stars and small stars in turn: each node hands its neighbours over to
    the least of them, until every node hangs on the least node it can reach.
    All steps are aggregations by node and joins with them, so a node with very
    many neighbours is combined map side and its join can be split. Each round
    is written to the shared folder. Pairs may repeat or join an id to itself;
    null ids are dropped; no pairs give no rows.
    """
    whole = pairs.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    lone = whole.where("u = v").select("u").distinct()
    edges = stored(
        whole.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"
    )
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stored(small, "edges")
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    named = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    heads = named.select("component").distinct().select(F.col("component").alias("id"), "component")
    both = named.unionByName(heads)
    rest = lone.select(F.col("u").alias("id")).join(both, "id", "left_anti")
    return both.unionByName(rest.select("id", F.col("id").alias("component")))


def _roots(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Each id of some pairs with the least id that these pairs join it to; that one with itself."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y, root = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while (root[x] != root[y]).any():
        np.minimum.at(root, np.maximum(root[x], root[y]), np.minimum(root[x], root[y]))
        while (root[root] != root).any():
            root = root[root]
    return pa.RecordBatch.from_arrays([pa.array(ids[root]), pa.array(ids)], ["a", "b"])


def forest(batches):
    """Pairs ``(a, b)`` without nulls to stars that join the same ids, for ``mapInArrow``: less for ``components`` to do."""
    held, rows = [], 0
    for batch in batches:
        held.append([batch.column(c).to_numpy() for c in ("a", "b")])
        rows += batch.num_rows
        if rows >= HELD:
            yield _roots(*map(np.concatenate, zip(*held)))
            held, rows = [], 0
    if rows:
        yield _roots(*map(np.concatenate, zip(*held)))
