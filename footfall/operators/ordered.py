"""Skew-safe building blocks for time-ordered groups.

A window over (date, visitor) or (date, camera) puts a whole group into one
task, and one visitor or camera may hold a large share of all rows. These
helpers first reduce the rows, map side, to what the window can see: at most
one row per second and region, or one per second. A day has 86,400 seconds, so
the group a window gets is bounded by the calendar and not by the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions import clock


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key, with their rank in ``rn``.

    The ``rn <= n`` filter becomes a group limit below the shuffle, so a group
    sends at most ``n`` rows per map task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rn", rank).where(F.col("rn") <= n)


def run_starts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """First row of every run of equal ``value`` along ``capture_time`` per key.

    Captures of one second are ordered by ``value`` and then ``capture_id``.
    ``keys`` must be columns that ``capture_time`` and a visitor determine.
    """
    per_second = top_rows(df, [*keys, "capture_time", value], [F.col("capture_id")]).drop("rn")
    here = F.struct(value)
    before = F.lag(F.struct(value)).over(run_window(keys, value))
    return (
        per_second.withColumn("_before", before)
        .where(~here.eqNullSafe(F.col("_before")))
        .drop("_before")
    )


def run_window(keys: Sequence[str], value: str):
    return Window.partitionBy(*keys).orderBy("capture_time", value, "capture_id")


def gap_groups(df: DataFrame, keys: Sequence[str], gap_s: int, first_group: int = 0) -> DataFrame:
    """Number the bursts per key: a gap above ``gap_s`` seconds starts a new one.

    Returns one row per distinct (keys, capture_time) with its ``group_id``.
    """
    times = df.select(*keys, "capture_time").distinct()
    w = Window.partitionBy(*keys).orderBy("capture_time")
    starts = F.coalesce(
        (clock.elapsed_seconds(F.col("_before"), F.col("capture_time")) > gap_s).cast("long"),
        F.lit(first_group).cast("long"),
    )
    return (
        times.withColumn("_before", F.lag("capture_time").over(w))
        .withColumn("_starts", starts)
        .withColumn("group_id", F.sum("_starts").over(w))
        .drop("_before", "_starts")
    )
