"""New and returning visitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.functions.buckets import is_short_stay
from footfall.operators.counting import flag_present


def new_or_return(
    stay: DataFrame,
    history: DataFrame | None = None,
    zone_lookback_months: int = 2,
    day_lookback: int = 1,
) -> DataFrame:
    """Flag each stay as returning and as shorter than 15 minutes.

    ``is_return_zone``: the visitor stayed in the region on the date exactly
    ``zone_lookback_months`` earlier. ``is_return_casino``: they have a stay there
    whose *business* date is the *calendar* date less ``day_lookback``. A stay
    before 06:00 lies on that business date itself, so it counts as returning.
    ``history`` holds the stays to look back on and defaults to ``stay``.
    """
    history = stay if history is None else history
    visitor = {"profile_id": F.col("profile_id"), "region_id": F.col("region_id")}
    flagged = flag_present(
        stay,
        history,
        {"date": clock.months_before(F.col("date"), zone_lookback_months), **visitor},
        "is_return_zone",
    )
    flagged = flag_present(
        flagged,
        history,
        {"date_casino": clock.days_before(F.col("date"), day_lookback), **visitor},
        "is_return_casino",
    )
    return flagged.select(
        "date", "date_casino", "profile_id", "region_id", "region_name", "region_type",
        "gender", "Age_range", "profile_type", "member_tier",
        "is_return_zone", "is_return_casino",
        F.when(is_short_stay(F.col("stay_time")), 1).otherwise(0).alias("is_less15min_visitor"),
    )
