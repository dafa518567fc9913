"""Mixing sources to target weights by pivotal dependent rounding.

A source gets a target number of words. Its documents share it in proportion to
their sizes, which makes a fractional number of copies of each. The whole part
is taken; the fractions are rounded by pivots: of two open documents, words move
from one to the other, in a random direction that keeps the expectation, until
one of them has no or one whole copy more. The total stays as it is, so only
the last open document of a source is rounded alone, to the nearer side.

Documents are dealt to buckets of bounded size, several for a large source, and
each bucket leaves at most one open document. These residuals are combined in a
tree, a bounded number at a time, up to one per source.

Edge cases: a null or empty text has size 0 and is taken 0 times; a null source
is a source of its own, last in order; repeated rows are rounded each by itself;
no documents give no rows. Equal rows may swap their shares, which shows nowhere.
All draws are hashes of ids and sizes: a rerun gives the same mix.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.sources.scratch import stored

WEIGHTS = (5, 2, 1)
#: A target stops at this many times the size of its source.
MOST = 3
#: Documents in a bucket about, and residuals combined at once.
BUCKET = 1024
FAN_IN = 256

WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source``, ``text_key`` and ``size`` in words of every row."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), words.alias("size"))


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, n_docs, source_size, target)``.

    Targets share the words of all documents by weight. With ``level`` words per
    weight a source gets ``min(most * size, level * weight)``; sources sorted by
    the level at which they are full show which level spends all words.
    One row per source goes through the two windows, never the documents.
    """
    sources = rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    full = F.lit(most) * F.col("source_size")
    sources = sources.withColumn("weight", pick).withColumn("full_at", full / F.col("weight"))
    order = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(F.sum(full).over(before), F.lit(0))
    # Level if all sources before this one are full and it and the later ones are not.
    sources = sources.withColumn("level", left / F.sum("weight").over(after))
    level = F.max(F.when(F.col("level") <= F.col("full_at"), F.col("level"))).over(Window.partitionBy())
    target = F.least(full.cast("double"), F.coalesce(level, F.lit(float("inf"))) * F.col("weight"))
    return sources.select("source", "n_docs", "source_size", target.cast("double").alias("target"))


def pivot(mass: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Round open masses between 0 and ``size``, one after another; at most one stays open.

    The total of ``mass`` is kept. ``draw`` are uniform numbers, one a step.
    """
    mass = mass.astype(float).copy()
    open_, slack = -1, 1e-9
    for i in range(len(mass)):
        if mass[i] <= slack * size[i] or mass[i] >= (1 - slack) * size[i]:
            mass[i] = size[i] if mass[i] > size[i] / 2 else 0.0
            continue
        if open_ < 0:
            open_ = i
            continue
        j = open_
        up = min(size[i] - mass[i], mass[j])  # words that can move from j to i
        down = min(mass[i], size[j] - mass[j])  # and from i to j
        move = up if draw[i] * (up + down) < down else -down
        mass[i] += move
        mass[j] -= move
        still = []
        for k in (j, i):
            if mass[k] <= slack * size[k]:
                mass[k] = 0.0
            elif mass[k] >= (1 - slack) * size[k]:
                mass[k] = size[k]
            else:
                still.append(k)
        open_ = still[-1] if still else -1
    return mass


def _round(level: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "order", "doc_id"], ascending=[False, True, True], kind="stable")
        size = group["size"].to_numpy(float)
        seed = pd.util.hash_array(group["order"].to_numpy(np.int64) + level) if len(group) else np.zeros(0)
        mass = pivot(group["mass"].to_numpy(float), size, (seed >> np.uint64(11)) / float(1 << 53))
        if last:
            mass = np.where(mass * 2 >= size, size, 0.0) * (size > 0)
        return group.assign(mass=mass)

    return run


def mix(rows: DataFrame, bucket: int = BUCKET, fan_in: int = FAN_IN) -> DataFrame:
    """``sized`` rows with ``source_size``, ``target``, ``copies`` and ``taken``."""
    rows = stored(rows, "mix-sizes")
    quota = stored(targets(rows), "mix-targets")
    # One row per source; joined by value, null sources included.
    joined = rows.alias("d").join(quota.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = joined.select(
        "d.*", "n_docs", "source_size", "target", F.xxhash64("doc_id", "size", "text_key").alias("order"), share.alias("share")
    )
    whole = F.floor(F.col("share") + F.lit(1e-12))
    joined = joined.withColumn("whole", whole).withColumn(
        "mass", F.greatest(F.col("share") - F.col("whole"), F.lit(0.0)) * F.col("size")
    )
    buckets = F.ceil(F.col("n_docs") / F.lit(bucket))
    joined = joined.withColumn("bucket", F.pmod(F.xxhash64("order"), buckets))
    level, settled = 0, []
    schema = joined.schema
    most = quota.agg(F.max(F.ceil(F.col("n_docs") / F.lit(bucket)))).first()[0] or 1
    current = joined
    while True:
        last = most <= 1
        done = stored(current.groupBy("source", "bucket").applyInPandas(_round(level, last), schema), "mix-level")
        is_open = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
        settled.append(done if last else done.where(~is_open))
        if last:
            break
        current = done.where(is_open).withColumn("bucket", F.floor(F.col("bucket") / F.lit(fan_in)))
        most, level = -(-most // fan_in), level + 1
    out = settled[0]
    for part in settled[1:]:
        out = out.unionByName(part)
    copies = (F.col("whole") + F.when((F.col("mass") > 0) & (F.col("size") > 0), 1).otherwise(0)).cast("bigint")
    return out.withColumn("copies", copies).select(
        "doc_id", "source", "text_key", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``mix``, as far as they are taken at least once.

    Rows that agree in id, source and text become one, taken as often as all of
    them. A column of ``docs`` named like one of the mixture gives way to it.
    """
    key = ("doc_id", "source", "text_key")
    first = [F.first(c).alias(c) for c in ("size", "source_size", "target")]
    found = mix(sized(docs)).groupBy(*key).agg(
        *first, F.sum("copies").alias("copies"), F.sum("taken").alias("taken"), F.count("*").alias("rows")
    )
    made = ("size", "source_size", "target", "copies", "taken")
    part = found.where("copies > 0").select(*(F.col(c).alias(f"__{c}") for c in (*key, *made, "rows")))
    own = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in made]
    rows = docs.select(own).withColumn("__text", F.xxhash64("text"))
    same = [F.col("doc_id").eqNullSafe(F.col("__doc_id")), F.col("source").eqNullSafe(F.col("__source"))]
    # One row a document: this side grows with the corpus and is not broadcast.
    joined = rows.join(part.hint("merge"), same[0] & same[1] & (F.col("__text") == F.col("__text_key")))
    again = joined.where("__rows > 1").dropDuplicates(["doc_id", "source", "__text"])
    out = joined.where("__rows = 1").unionByName(again)
    return out.select(*own, *(F.col(f"__{c}").alias(c) for c in made))
