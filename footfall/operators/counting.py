"""Aggregations shared by the reporting operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_members(
    df: DataFrame,
    keys: Sequence[str],
    member: str,
    counts: dict[str, Column | None],
    sums: dict[str, Column] | None = None,
) -> DataFrame:
    """Distinct ``member`` values per key, one count per condition, plus sums.

    Several ``count(distinct case ..)`` in one ``agg`` would copy every input
    row once per count. Two plain aggregations give the same numbers: first one
    row per (keys, member) with a flag per condition, then the flags added up.
    Both combine map side and a hot key is spread over its members.
    """
    sums = sums or {}
    known = F.col(member).isNotNull()
    flags = [
        F.max(F.coalesce(known if cond is None else known & cond, F.lit(False)).cast("long")).alias(name)
        for name, cond in counts.items()
    ]
    per_member = df.groupBy(*keys, member).agg(
        *flags, *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    return per_member.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in [*counts, *sums]])


def fill_with_group_mean(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Nulls become the mean of their group, or 0 where the group has none.

    The mean is aggregated and joined back; a window would pull every row of a
    group into one task.
    """
    means = df.groupBy(*keys).agg(F.avg(value).alias("_mean"))
    return (
        df.join(means, list(keys), "left")
        .withColumn(value, F.coalesce(value, "_mean", F.lit(0.0)))
        .select(df.columns)
    )


def flag_present(df: DataFrame, present: DataFrame, on: dict[str, Column], name: str) -> DataFrame:
    """Add ``name`` = 1 where the key expressions ``on`` occur in ``present``, else 0.

    ``on`` maps a column of ``present`` to an expression over ``df``. The keys
    are made distinct first, so the join never adds rows.
    """
    hits = present.select(*on).distinct().select(
        *[F.col(c).alias(f"_k_{c}") for c in on], F.lit(1).alias("_hit")
    )
    keyed = df.select("*", *[expr.alias(f"_k_{c}") for c, expr in on.items()])
    keys = [f"_k_{c}" for c in on]
    # Keys grow with the rows they are of; a file of them is small for what they take in memory, so they are not broadcast.
    return (
        keyed.join(hits.hint("merge"), keys, "left")
        .withColumn(name, F.coalesce(F.col("_hit"), F.lit(0)))
        .drop("_hit", *keys)
    )
