"""Daily rollups by region and visitor attributes."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.buckets import age_range, is_short_stay
from footfall.operators.counting import count_members

KEYS = [
    "date", "date_casino", "region_id", "region_name", "region_type",
    "gender", "Age_range", "profile_type", "member_tier",
]


def demographics(detail: DataFrame, stay: DataFrame, flags: DataFrame) -> DataFrame:
    """Visitors, stay time, short visits and new / returning visitors per day.

    The three inputs are stacked and counted in one go; each adds to its own
    columns. A union also keeps null keys (unknown age) together, unlike a join.
    """
    visited = (
        detail.where("capture_time is not null")
        .withColumn("date", F.to_date("capture_time"))
        .withColumn("date_casino", clock.business_date(F.col("capture_time")))
        .withColumn("Age_range", age_range(F.col("age")))
        .select(*KEYS, "profile_id", F.lit("detail").alias("_from"))
    )
    stayed = stay.select(
        *KEYS, "profile_id", F.lit("stay").alias("_from"),
        "stay_time", is_short_stay(F.col("stay_time")).alias("_short"),
    )
    flagged = flags.select(
        *KEYS, "profile_id", F.lit("flags").alias("_from"), "is_return_zone", "is_return_casino"
    )
    stacked = visited.unionByName(stayed, True).unionByName(flagged, True)
    counted = count_members(
        stacked,
        KEYS,
        "profile_id",
        {
            "visitors_num": F.col("_from") == "detail",
            "less15min_visitor_num": F.col("_short"),
            "new_zone_num": F.col("is_return_zone") == 0,
            "return_zone_num": F.col("is_return_zone") == 1,
            "new_casino_num": F.col("is_return_casino") == 0,
            "return_casino_num": F.col("is_return_casino") == 1,
        },
        {"stay_time": F.coalesce("stay_time", F.lit(0))},
    )
    return counted.select(
        *KEYS,
        "visitors_num",
        F.col("stay_time").cast("decimal(18,2)").alias("stay_time"),
        "less15min_visitor_num", "new_zone_num", "return_zone_num", "new_casino_num", "return_casino_num",
    )


def daily_demographic_visitors(profile_agg: DataFrame) -> DataFrame:
    """Distinct visitors per date, region and attributes."""
    keys = ["date", "region_id", "region_name", "region_type", "gender", "Age_range", "profile_type"]
    return count_members(
        profile_agg.withColumn("region_type", F.lit("")), keys, "profile_id", {"visitors_num": None}
    )


def daily_user_stats(user_stats: DataFrame, date: Date | None = None) -> DataFrame:
    """Users, page views and clicks per date, for one date or all of them."""
    if date is not None:
        user_stats = user_stats.where(F.col("date") == F.lit(date))
    return count_members(
        user_stats,
        ["date"],
        "user_id",
        {"total_users": None},
        {"total_views": F.col("page_views"), "total_clicks": F.col("clicks")},
    )
