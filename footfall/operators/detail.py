"""Visit detail: where each visitor went and when they moved on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.operators.ordered import run_starts, run_window


def visit_detail(captures: DataFrame) -> DataFrame:
    """Captures that change region, with the time of the next change.

    Per visitor and date: a capture is kept if its region differs from the
    capture before it. ``next_capture_time`` is null on the last one of the day.
    """
    keys = ["date", "profile_id"]
    moves = run_starts(
        captures.where("capture_time is not null")
        .withColumn("region_type", F.lit(""))
        .withColumn("date", F.to_date("capture_time")),
        keys,
        "region_id",
    )
    left = F.lead("capture_time").over(run_window(keys, "region_id"))
    return moves.withColumn("next_capture_time", left).drop("date")


def dedupe_consecutive(captures: DataFrame) -> DataFrame:
    """First capture of each stay in a region, regions told apart by name."""
    return run_starts(
        captures.where("capture_time is not null").withColumn("date", F.to_date("capture_time")),
        ["date", "profile_id"],
        "region_name",
    ).drop("date")
