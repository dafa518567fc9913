"""Stay time per visitor, region and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from footfall.functions import clock
from footfall.functions.buckets import age_range
from footfall.operators.counting import fill_with_group_mean
from footfall.operators.ordered import top_rows

SECONDS = "decimal(18,2)"


def stay_time(detail: DataFrame) -> DataFrame:
    """Longest stay in seconds per visitor, region, day and attributes.

    A stay of 0 (no next move) takes the average of the region on that calendar
    and business day: over visitors with a known next move, of their longest.
    """
    region_day = ["date", "date_casino", "region_id"]
    visits = (
        detail.where("capture_time is not null")
        .withColumn("date", F.to_date("capture_time"))
        .withColumn("date_casino", clock.business_date(F.col("capture_time")))
        .withColumn("Age_range", age_range(F.col("age")))
        .withColumn("_stay", clock.elapsed_seconds(F.col("capture_time"), F.col("next_capture_time")))
    )
    stays = visits.groupBy(
        "date", "date_casino", "profile_id", "region_id", "region_name", "region_type",
        "member_tier", "gender", "Age_range", "profile_type",
    ).agg(
        F.count("camera_id").alias("capture_count"),
        F.max(F.coalesce("_stay", F.lit(0))).alias("_longest"),
    )
    averages = (
        visits.where("_stay is not null")
        .groupBy(*region_day, "profile_id")
        .agg(F.max("_stay").alias("_longest"))
        .groupBy(*region_day)
        .agg(_average_in_cents(F.sum("_longest"), F.count("profile_id")).alias("_cents"))
    )
    average = F.coalesce("_cents", F.lit(0)).cast("decimal(20,0)") / 100
    filled = F.when(F.col("_longest") == 0, average).otherwise(F.col("_longest"))
    return (
        stays.join(averages, region_day, "left")
        .withColumn("stay_time", filled.cast(SECONDS))
        .drop("_longest", "_cents")
    )


def _average_in_cents(total: Column, n: Column) -> Column:
    """``total / n`` rounded half to even to two digits, times 100, in whole numbers."""
    cents = F.call_function("div", total * 100, n)
    twice_left = (total * 100 - cents * n) * 2
    return cents + F.when((twice_left > n) | ((twice_left == n) & (cents % 2 == 1)), 1).otherwise(0)


def stay_time_segments(captures: DataFrame) -> DataFrame:
    """Longest stay per visitor, region and business day, straight from captures.

    Unlike ``stay_time`` a stay is cut at 06:00, where the business day changes,
    and only stays with no length at all take the region mean (unrounded).
    Attributes are the first known ones of the visitor in the region.
    """
    day = ["date", "date_casino", "profile_id"]
    attributes = ["profile_type", "member_tier", "Age_range", "gender", "region_name", "region_type"]
    seen = (
        captures.where("capture_time is not null and profile_id is not null and region_id is not null")
        .withColumn("date", F.to_date("capture_time"))
        .withColumn("date_casino", clock.business_date(F.col("capture_time")))
        .withColumn("Age_range", age_range(F.col("age")))
        .withColumn("region_type", F.lit(""))
        .select(*day, "capture_time", "region_id", "capture_id", *attributes)
    )
    # Of each second and region one row for every set of known attributes: all that can be first known.
    unknown = sum((F.when(F.col(a).isNull(), 1 << i).otherwise(0) for i, a in enumerate(attributes)), F.lit(0))
    seen = top_rows(seen.withColumn("_unknown", unknown), [*day, "capture_time", "region_id", "_unknown"], [F.col("capture_id")])
    # Everything else happens within a visitor's day, after one shuffle.
    part = Window.partitionBy(*day)
    onward = part.orderBy("capture_time", "region_id", "capture_id")
    back = part.orderBy(*(F.col(c).desc() for c in ("capture_time", "region_id", "capture_id")))
    before = F.lag("region_id").over(onward)
    starts = seen.withColumn("_start", F.when(before.isNull() | (before != F.col("region_id")), F.col("capture_time")))
    following = F.last("_start", ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    stay = clock.elapsed_seconds(F.col("_start"), F.col("_next")).cast("double")
    in_region = Window.partitionBy(*day, "region_id").orderBy("capture_time", "capture_id")
    whole = in_region.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    longest = (
        starts.withColumn("_next", following)
        .withColumns(
            {
                "stay_time": F.max(stay).over(whole),
                **{a: F.first(a, ignorenulls=True).over(whole) for a in attributes},
                "_row": F.row_number().over(in_region),
            }
        )
        .where("_row = 1")
        .select(*day, "region_id", "stay_time", *attributes)
    )
    return fill_with_group_mean(longest, ["date", "date_casino", "region_id"], "stay_time").select(
        "profile_id", "date", "date_casino", "region_id", "stay_time", *attributes
    )
