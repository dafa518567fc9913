"""Hourly visitation: visits split at full hours, with group, stay and return flags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.buckets import age_range
from footfall.operators.counting import count_members


def hour_slices(detail: DataFrame) -> DataFrame:
    """One row per hour a visit touches, with the part of it in that hour."""
    start = F.col("capture_time")
    end = F.coalesce("next_capture_time", "capture_time")
    i = F.col("_slice")
    sliced = (
        detail.withColumn("_end", end)
        .withColumn("hour_diff", clock.boundary_hours(start, F.col("_end")))
        .where("hour_diff >= 0")
        .withColumn("_hour", clock.hour_floor(start))
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("hour_diff"))))
    )
    hour = F.col("_hour")
    return (
        sliced.withColumn("corrected_start", F.when(i == 0, start).otherwise(clock.shift_hours(hour, i)))
        .withColumn(
            "corrected_end",
            F.when(i == F.col("hour_diff"), F.col("_end")).otherwise(clock.shift_hours(hour, i + 1)),
        )
        .drop("_slice", "_end", "_hour")
    )


def hourly_visitation(
    detail: DataFrame, groups: DataFrame, stay: DataFrame, flags: DataFrame
) -> DataFrame:
    """Hour slices of each visit with arrival group, stay time and return flags.

    Stay and flags are found by date and business date of the slice, visitor and
    region; a visitor with two sets of attributes that day gives two rows. Slices
    without a match get 0, and no arrival group.
    """
    slices = hour_slices(detail.withColumn("Age_range", age_range(F.col("age")))).select(
        "profile_id", "region_type", "region_id", "region_name", "gender", "Age_range",
        "profile_type", "member_tier", "capture_time", "hour_diff", "corrected_start", "corrected_end",
        F.to_date("corrected_start").alias("date"),
        clock.business_date(F.col("corrected_start")).alias("date_casino"),
    )
    day = ["date", "date_casino", "profile_id", "region_id"]
    arrivals = groups.select(
        F.col("capture_time").alias("corrected_start"), "profile_id", "region_id", "group_id"
    )
    # stay and flags share their keys, so one shuffle of the slices serves both. All three grow with the captures and
    # are not broadcast: their files are small for what they take in the memory of each task.
    joined = (
        slices.join(stay.select(*day, "stay_time").hint("merge"), day, "left")
        .join(
            flags.select(*day, "is_less15min_visitor", "is_return_casino", "is_return_zone").hint("merge"), day, "left"
        )
        .join(arrivals.hint("merge"), ["corrected_start", "profile_id", "region_id"], "left")
    )
    return joined.select(
        clock.hour_floor(F.col("corrected_start")).alias("date_hour"),
        clock.business_hour(F.col("corrected_start")).alias("date_casino_hour"),
        "profile_id", "region_type", "region_id", "region_name", "gender", "Age_range",
        "profile_type", "member_tier", "capture_time", "hour_diff", "corrected_start", "corrected_end",
        "group_id",
        F.coalesce("stay_time", F.lit(0)).cast("decimal(18,2)").alias("stay_time"),
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("is_less15min_visitor", "is_return_casino", "is_return_zone")
        ],
    )


def hourly_visitors(
    detail: DataFrame, offset_hours: int = clock.BUSINESS_OFFSET_HOURS, person: str = "person_id"
) -> DataFrame:
    """Distinct persons per region and hour, on both clocks, as text labels."""
    ts = F.col("capture_time")
    business = clock.business_time(ts, offset_hours)
    labelled = detail.where("capture_time is not null").select(
        clock.hour_text(ts).alias("date"),
        clock.hour_label(ts).alias("date_hour"),
        clock.hour_text(business).alias("date_casino"),
        clock.hour_label(business).alias("date_casino_hour"),
        "region_id", "region_name", "region_type", person,
    )
    keys = [c for c in labelled.columns if c != person]
    return count_members(labelled, keys, person, {"visitors_num": None})
