"""Bursts of a stream: per key, events with no more than a gap between neighbours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streamed_bursts(events: DataFrame, keys: Sequence[str], time: str, gap_s: int, delay: str = "1 hour") -> DataFrame:
    """First and last time and number of the events of each burst: ``(*keys, first, last, events)``.

    An event more than ``gap_s`` seconds after the one before it begins a burst. On a stream a burst
    is given out, once, when ``delay`` has passed in event time since it ended, and its state ends then;
    events that come later than that are dropped, and counted by Spark in the progress of the query. Events
    without a time are left out. A batch gives all bursts.

    State is one row per open burst, not per event; events of a batch are merged within each
    task before they are shuffled by key.
    """
    if gap_s <= 0:
        raise ValueError("the gap has to be positive")
    # Windows that touch are one: a gap of just gap_s still joins.
    window = F.session_window(time, f"{gap_s} seconds")
    events = events.withColumn(time, F.col(time).cast("timestamp"))
    if events.isStreaming:
        events = events.withWatermark(time, delay)
    found = events.where(F.col(time).isNotNull()).groupBy(*keys, window.alias("_burst")).agg(F.count("*").alias("events"))
    last = F.col("_burst.end") - F.expr(f"INTERVAL '{gap_s}' SECOND")
    return found.select(*keys, F.col("_burst.start").alias("first"), last.alias("last"), "events")
