"""Arrival groups: visitors who pass one camera within seconds of each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.buckets import group_size_label
from footfall.operators.counting import count_members
from footfall.operators.ordered import gap_groups, top_rows

# Fixed value: the entrance camera.
ENTRANCE_CAMERA = 94


def arrival_groups(
    captures: DataFrame,
    camera_id: int = ENTRANCE_CAMERA,
    gap_s: int = 2,
    order: str = "dedup_first",
) -> DataFrame:
    """Group the captures at ``camera_id``; a gap above ``gap_s`` starts a group.

    One row per visitor and hour, their last capture. ``dedup_first`` forms the
    groups from those rows and counts from 0. ``group_first`` forms them from
    all captures at the camera and counts from 1.
    """
    if order not in ("dedup_first", "group_first"):
        raise ValueError(f"unknown order {order!r}")
    at_camera = (
        captures.where("capture_time is not null")
        .where(F.col("camera_id") == camera_id)
        .select("capture_id", "profile_id", "region_id", "region_name", "capture_time")
        .withColumn("date", F.to_date("capture_time"))
        .withColumn("date_hour", clock.hour_floor(F.col("capture_time")))
    )
    latest = [F.col("capture_time").desc(), F.col("capture_id")]
    last_seen = top_rows(at_camera, ["date_hour", "profile_id"], latest)
    # The group of a row depends on its second alone, so the running count goes
    # over the seconds of a day and is joined back.
    if order == "dedup_first":
        numbers = gap_groups(last_seen, ["date"], gap_s, first_group=0)
    else:
        numbers = gap_groups(at_camera, ["date"], gap_s, first_group=1)
        last_seen = last_seen.where("profile_id is not null")
    return last_seen.join(numbers, ["date", "capture_time"]).select(
        "date_hour",
        clock.business_hour(F.col("capture_time")).alias("date_casino_hour"),
        "profile_id",
        "region_id",
        "region_name",
        "group_id",
        "capture_time",
    )


def group_sizes(groups: DataFrame) -> DataFrame:
    """Visitors per arrival group and hour, with a size label."""
    return count_members(
        groups, ["date_hour", "date_casino_hour", "group_id"], "profile_id", {"group_size": None}
    ).withColumn("group_type", group_size_label(F.col("group_size")))
