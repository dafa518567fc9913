"""Distinct counts that add up: bitmaps of members per day, merged to any longer time.

Members get dense numbers first, so that a bitmap of 32,768 members is well filled whatever
their ids look like. A bitmap per key and bucket is at most 4 KB; buckets of a hot key
lie in different rows, and all steps are aggregations that combine map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.prefix import numbered


def member_numbers(df: DataFrame, member: str, known: DataFrame | None = None) -> DataFrame:
    """``(member, number)`` of members that ``known``, of the same columns, does not have, numbered on from its end."""
    members = df.select(member).where(F.col(member).isNotNull()).distinct()
    first = 0
    if known is not None:
        members = members.join(known.select(member), member, "left_anti")
        last = known.agg(F.max("number")).first()[0]
        first = 0 if last is None else last + 1
    found = numbered(members, [member])
    return found.withColumn("number", F.col("number") + F.lit(first).cast("long"))


def member_bitmaps(df: DataFrame, keys: Sequence[str], member: str, numbers: DataFrame) -> DataFrame:
    """One bitmap of members per (keys, bucket): rows ``(*keys, bucket, members)``."""
    rows = df.select(*keys, member).where(F.col(member).isNotNull()).join(numbers, member)
    bucket, bit = F.bitmap_bucket_number("number"), F.bitmap_bit_position("number")
    return rows.groupBy(*keys, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("members"))


def merged_counts(bitmaps: DataFrame, keys: Sequence[str], name: str = "members") -> DataFrame:
    """Distinct members per ``keys``, exactly, from bitmaps of smaller groups."""
    merged = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("members").alias("_bits"))
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias(name))
