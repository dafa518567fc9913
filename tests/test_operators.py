import os
import sys
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import DAY, at, captures, rows_of  # noqa: E402

from footfall.functions import clock  # noqa: E402
from footfall.operators.counting import count_members, fill_with_group_mean, flag_present  # noqa: E402
from footfall.operators.demographics import daily_user_stats, demographics  # noqa: E402
from footfall.operators.detail import dedupe_consecutive, visit_detail  # noqa: E402
from footfall.operators.groups import arrival_groups, group_sizes  # noqa: E402
from footfall.operators.ordered import gap_groups  # noqa: E402
from footfall.operators.returning import new_or_return  # noqa: E402
from footfall.operators.stay import stay_time, stay_time_segments  # noqa: E402
from footfall.operators.visitation import hour_slices, hourly_visitation, hourly_visitors  # noqa: E402


def visits(spark, rows):
    return visit_detail(captures(spark, rows))


# Visit detail ---------------------------------------------------------------


def test_a_a_b_a_keeps_a_b_a(spark):
    detail = visits(spark, [(1, "08:00:00", 7), (1, "08:05:00", 7), (1, "08:10:00", 8), (1, "08:20:00", 7)])
    assert rows_of(detail, "capture_id", "region_id") == [(0, 7), (2, 8), (3, 7)]
    nexts = {r.capture_id: r.next_capture_time for r in detail.collect()}
    assert nexts == {0: at("08:10:00"), 2: at("08:20:00"), 3: None}


def test_detail_does_not_cross_midnight_or_visitors(spark):
    detail = visits(
        spark,
        [(1, "23:59:00", 7), (1, "00:01:00", 7, {"day": "2024-03-06"}), (2, "23:59:30", 7)],
    )
    assert {r.capture_id: r.next_capture_time for r in detail.collect()} == {0: None, 1: None, 2: None}


def test_ties_go_by_region_then_id(spark):
    detail = visits(spark, [(1, "08:00:00", 9), (1, "08:00:00", 7), (1, "08:00:00", 9), (1, "08:00:00", 7)])
    assert rows_of(detail, "capture_id", "region_id") == [(0, 9), (1, 7)]


def test_detail_null_and_zero_regions(spark):
    detail = visits(
        spark, [(1, "08:00:00", 0), (1, "08:01:00", None), (1, "08:02:00", None), (1, "08:03:00", 0)]
    )
    assert sorted(r.capture_id for r in detail.collect()) == [0, 1, 3]


def test_detail_keeps_all_columns_and_order_of_input(spark):
    df = captures(spark, [(1, "08:00:00", 7)]).withColumn("album_id", F.lit("x"))
    detail = visit_detail(df)
    assert detail.columns == [*df.columns, "region_type", "next_capture_time"]
    assert dict(detail.dtypes)["next_capture_time"] == "timestamp_ntz"


def test_dedupe_consecutive_goes_by_name(spark):
    rows = [
        (1, "08:00:00", 1, {"region_name": "A"}),
        (1, "08:01:00", 2, {"region_name": "A"}),
        (1, "08:02:00", 3, {"region_name": "B"}),
    ]
    assert rows_of(dedupe_consecutive(captures(spark, rows)), "capture_id") == [(0,), (2,)]


# Arrival groups -------------------------------------------------------------

WORKED = ["09:10:00", "09:10:02", "09:10:03", "09:10:07", "09:10:08"]


def test_worked_group_example(spark):
    rows = captures(spark, [(i, t, 3) for i, t in enumerate(WORKED)])
    sql = arrival_groups(rows)
    first = arrival_groups(rows, order="group_first")
    assert [r[1] for r in rows_of(sql, "profile_id", "group_id")] == [0, 0, 0, 1, 1]
    assert [r[1] for r in rows_of(first, "profile_id", "group_id")] == [1, 1, 1, 2, 2]


def test_groups_keep_the_last_capture_of_the_hour(spark):
    rows = captures(
        spark,
        [(1, "08:00:00", 3), (1, "08:00:30", 3), (2, "08:00:01", 3), (1, "09:00:00", 3),
         (3, "08:00:00", 3, {"camera_id": 5})],
    )
    got = rows_of(arrival_groups(rows), "profile_id", "capture_time", "group_id")
    assert got == [(1, at("08:00:30"), 1), (1, at("09:00:00"), 2), (2, at("08:00:01"), 0)]
    # All captures are grouped before the last one is picked.
    got = rows_of(arrival_groups(rows, order="group_first"), "profile_id", "capture_time", "group_id")
    assert got == [(1, at("08:00:30"), 2), (1, at("09:00:00"), 3), (2, at("08:00:01"), 1)]


def test_group_hours_and_types(spark):
    groups = arrival_groups(captures(spark, [(1, "05:10:00", 3)]))
    row = groups.first()
    assert (row.date_hour, row.date_casino_hour) == (at("05:00:00"), at("23:00:00", "2024-03-04"))
    types = dict(groups.dtypes)
    assert types["date_hour"] == types["date_casino_hour"] == "timestamp_ntz" and types["group_id"] == "bigint"


def test_groups_start_over_each_day(spark):
    rows = captures(spark, [(1, "08:00:00", 3), (2, "09:00:00", 3), (1, "08:00:00", 3, {"day": "2024-03-06"})])
    assert sorted(r.group_id for r in arrival_groups(rows).collect()) == [0, 0, 1]


def test_group_sizes(spark):
    rows = captures(spark, [(i, "08:00:00", 3) for i in range(6)] + [(9, "08:30:00", 3)])
    assert rows_of(group_sizes(arrival_groups(rows)), "group_id", "group_size", "group_type") == [
        (0, 6, "5+"), (1, 1, "1"),
    ]


def test_unknown_order_is_refused(spark):
    with pytest.raises(ValueError):
        arrival_groups(captures(spark, []), order="other")


# Stay time ------------------------------------------------------------------


def test_stay_is_longest_visit_and_zero_takes_the_average(spark):
    detail = visits(
        spark,
        [
            (1, "10:00:00", 1), (1, "10:10:00", 2), (1, "10:20:00", 1), (1, "10:50:00", 3),
            (2, "11:00:00", 1), (2, "11:00:10", 2),
            (3, "12:00:00", 1),
            (4, "12:00:00", 4),
        ],
    )
    got = {(r.profile_id, r.region_id): (r.stay_time, r.capture_count) for r in stay_time(detail).collect()}
    assert got[1, 1] == (Decimal("1800.00"), 2)
    assert got[2, 1] == (Decimal("10.00"), 1)
    assert got[3, 1] == (Decimal("905.00"), 1)  # (1800 + 10) / 2
    assert got[4, 4] == (Decimal("0.00"), 1)  # nobody has a known stay there
    assert got[2, 2] == (Decimal("600.00"), 1)  # visitor 1 stayed 600 s


def test_average_is_rounded_half_to_even_and_kept_per_business_day(spark):
    rows = [(p, "10:00:00", 1) for p in range(8)]
    rows += [(p, f"10:00:{20 + (p == 0):02d}", 2) for p in range(8)]  # one stays 21 s, seven 20 s
    rows += [(50, "10:30:00", 1), (51, "05:00:00", 1)]
    rows += [(p, "11:00:00", 3) for p in range(8)] + [(p, f"11:00:{20 + (p < 3)}", 4) for p in range(8)]  # three stay 21 s
    rows += [(52, "11:30:00", 3)]
    got = {(r.profile_id, r.region_id): r.stay_time for r in stay_time(visits(spark, rows)).collect()}
    assert got[50, 1] == Decimal("20.12")  # 20.125
    assert got[52, 3] == Decimal("20.38")  # 20.375
    assert got[51, 1] == Decimal("0.00")  # another business day


def test_stay_cut_at_six_in_segments(spark):
    df = captures(spark, [(1, "05:30:00", 1), (1, "07:10:00", 2), (1, "07:40:00", 3)])
    got = {(r.region_id, str(r.date_casino)): r.stay_time for r in stay_time_segments(df).collect()}
    assert got == {(1, "2024-03-04"): 0.0, (2, DAY): 1800.0, (3, DAY): 0.0}
    whole = {r.region_id: r.stay_time for r in stay_time(visit_detail(df)).collect()}
    assert whole[1] == Decimal("6000.00")


def test_segments_fill_missing_with_region_mean(spark):
    df = captures(
        spark,
        [(1, "10:00:00", 1), (1, "10:00:10", 2), (2, "10:00:00", 1), (2, "10:00:21", 2), (3, "11:00:00", 1)],
    )
    got = {(r.profile_id, r.region_id): r.stay_time for r in stay_time_segments(df).collect()}
    assert got[3, 1] == 15.5 and got[1, 2] == 0.0


def test_segments_take_first_known_attributes(spark):
    df = captures(
        spark,
        [
            (1, "10:00:00", 1, {"member_tier": None, "age": 200}),
            (1, "10:00:05", 1, {"member_tier": "Silver", "age": 20}),
            (1, "10:00:09", 1, {"member_tier": "Gold", "age": 30}),
            (1, "10:01:00", None),
            (None, "10:01:00", 1),
        ],
    )
    rows = stay_time_segments(df).collect()
    assert [(r.profile_id, r.region_id, r.member_tier, r.Age_range) for r in rows] == [(1, 1, "Silver", "65+")]


# New or returning -----------------------------------------------------------


def stays(spark, rows):
    """Rows of (date, business date, profile, region, seconds)."""
    df = spark.createDataFrame(
        [(date.fromisoformat(d), date.fromisoformat(b), p, r, Decimal(s)) for d, b, p, r, s in rows],
        "date date, date_casino date, profile_id long, region_id long, stay_time decimal(18,2)",
    )
    return df.select(
        "*", F.lit("R").alias("region_name"), F.lit("").alias("region_type"), F.lit(1).alias("gender"),
        F.lit("21-39").alias("Age_range"), F.lit(1).alias("profile_type"), F.lit("").alias("member_tier"),
    )


def test_returning_flags(spark):
    stay = stays(
        spark,
        [
            ("2024-04-30", "2024-04-30", 1, 1, "900"),
            ("2024-02-29", "2024-02-29", 1, 1, "899.99"),  # two months before, clamped
            ("2024-04-29", "2024-04-29", 1, 1, "10"),
            ("2024-04-29", "2024-04-28", 2, 1, "10"),  # before 06:00: matches itself
            ("2024-04-30", "2024-04-30", 3, 1, "10"),
            ("2024-04-29", "2024-04-29", 3, 2, "10"),  # another region does not count
        ],
    )
    got = {
        (str(r.date), r.profile_id, r.region_id): (r.is_return_zone, r.is_return_casino, r.is_less15min_visitor)
        for r in new_or_return(stay).collect()
    }
    assert got == {
        ("2024-04-30", 1, 1): (1, 1, 0),
        ("2024-02-29", 1, 1): (0, 0, 1),
        ("2024-04-29", 1, 1): (1, 0, 1),
        ("2024-04-29", 2, 1): (0, 1, 1),
        ("2024-04-30", 3, 1): (0, 0, 1),
        ("2024-04-29", 3, 2): (0, 0, 1),
    }


def test_flags_use_history_and_never_fan_out(spark):
    today = stays(spark, [("2024-04-30", "2024-04-30", 1, 1, "900")] * 2)
    history = stays(spark, [("2024-04-29", "2024-04-29", 1, 1, "1")] * 3)
    rows = new_or_return(today, history).collect()
    assert [r.is_return_casino for r in rows] == [1, 1]
    assert dict(new_or_return(today).dtypes)["is_return_zone"] == "int"


def test_lookbacks_are_parameters(spark):
    stay = stays(spark, [("2024-04-30", "2024-04-30", 1, 1, "9"), ("2024-03-30", "2024-03-30", 1, 1, "9")])
    got = {str(r.date): r.is_return_zone for r in new_or_return(stay, zone_lookback_months=1).collect()}
    assert got == {"2024-04-30": 1, "2024-03-30": 0}


# Hourly visitation ----------------------------------------------------------


def test_stay_over_six_is_cut_in_three(spark):
    detail = visits(spark, [(1, "05:30:00", 1), (1, "07:10:00", 2)])
    slices = rows_of(hour_slices(detail).where("region_id = 1"), "corrected_start", "corrected_end", "hour_diff")
    assert slices == [
        (at("05:30:00"), at("06:00:00"), 2),
        (at("06:00:00"), at("07:00:00"), 2),
        (at("07:00:00"), at("07:10:00"), 2),
    ]
    stay = stay_time(detail)
    whole = hourly_visitation(detail, arrival_groups(captures(spark, [(1, "05:30:00", 1)])), stay, new_or_return(stay))
    got = {r.corrected_start: r for r in whole.where("region_id = 1").collect()}
    assert got[at("05:30:00")].stay_time == Decimal("6000.00") and got[at("05:30:00")].group_id == 0
    # After 06:00 it is another business day, without a stay of its own.
    assert got[at("06:00:00")].stay_time == Decimal("0.00") and got[at("06:00:00")].group_id is None
    assert got[at("05:30:00")].date_casino_hour == at("23:00:00", "2024-03-04")
    assert got[at("05:30:00")].is_return_casino == 1 and got[at("06:00:00")].is_return_casino == 0


def test_last_visit_of_the_day_is_one_slice(spark):
    detail = visits(spark, [(1, "10:59:59", 1)])
    assert rows_of(hour_slices(detail), "corrected_start", "corrected_end") == [(at("10:59:59"), at("10:59:59"))]


def test_visitation_fans_out_on_two_sets_of_attributes(spark):
    detail = visits(
        spark, [(1, "10:00:00", 1), (1, "10:01:00", 2), (1, "10:02:00", 1, {"member_tier": "Basic"})]
    )
    stay = stay_time(detail)
    groups = arrival_groups(captures(spark, []))
    result = hourly_visitation(detail, groups, stay, new_or_return(stay))
    # 2 visits x 2 stays x 2 flag rows in region 1, one row in region 2.
    assert result.where("region_id = 1").count() == 8 and result.where("region_id = 2").count() == 1
    types = dict(result.dtypes)
    assert types["stay_time"] == "decimal(18,2)" and types["is_return_zone"] == "int"


def test_hourly_visitors_offset(spark):
    detail = visits(spark, [(1, "05:30:00", 1), (2, "05:40:00", 1)]).withColumn("person_id", F.col("profile_id"))
    row = hourly_visitors(detail).first()
    assert (row.date, row.date_hour, row.date_casino, row.date_casino_hour, row.visitors_num) == (
        "2024-03-05 05:00:00", "05:00", "2024-03-04 23:00:00", "23:00", 2,
    )
    assert hourly_visitors(detail, offset_hours=6).first().date_casino == "2024-03-05 11:00:00"


# Rollups --------------------------------------------------------------------


def test_demographics_counts(spark):
    detail = visits(
        spark,
        [(1, "10:00:00", 1), (1, "10:20:00", 2), (2, "10:00:00", 1), (2, "10:05:00", 2), (3, "10:00:00", 1, {"age": None})],
    )
    stay = stay_time(detail)
    result = demographics(detail, stay, new_or_return(stay))
    got = {(r.region_id, r.Age_range): r for r in result.collect()}
    row = got[1, "21-39"]
    assert (row.visitors_num, row.stay_time, row.less15min_visitor_num) == (2, Decimal("1500.00"), 1)
    assert (row.new_zone_num, row.return_zone_num, row.new_casino_num, row.return_casino_num) == (2, 0, 2, 0)
    assert got[1, None].visitors_num == 1  # unknown age stays one group
    assert dict(result.dtypes)["visitors_num"] == "bigint"


def test_daily_user_stats_for_one_date(spark):
    stats = spark.createDataFrame(
        [(date(2024, 5, 7), 31, 6, 2), (date(2024, 5, 7), 31, 2, 3), (date(2024, 5, 8), 1, 1, 1)],
        "date date, user_id long, page_views int, clicks int",
    )
    assert rows_of(daily_user_stats(stats, date(2024, 5, 7)), "total_users", "total_views", "total_clicks") == [
        (1, 8, 5)
    ]


def test_count_members_ignores_null_members(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", None, 7), ("b", None, 1)], "k string, m long, v long")
    got = rows_of(count_members(df, ["k"], "m", {"n": None, "big": F.col("v") > 4}, {"v": F.col("v")}), "k", "n", "big", "v")
    assert got == [("a", 1, 1, 12), ("b", 0, 0, 1)]


def test_fill_and_flag(spark):
    df = spark.createDataFrame([(1, 2.0), (1, None), (2, None)], "k long, x double")
    assert rows_of(fill_with_group_mean(df, ["k"], "x"), "k", "x") == [(1, 2.0), (1, 2.0), (2, 0.0)]
    days = spark.createDataFrame([(1, date(2024, 1, 2)), (1, date(2024, 1, 1))], "k long, d date")
    on = {"k": F.col("k"), "d": clock.days_before(F.col("d"), 1)}
    assert rows_of(flag_present(days, days, on, "hit"), "d", "hit") == [(date(2024, 1, 1), 0), (date(2024, 1, 2), 1)]


def test_gap_groups_with_equal_times(spark):
    times = [at("08:00:00") + timedelta(seconds=s) for s in (0, 0, 2, 5)]
    df = spark.createDataFrame([("x", t) for t in times], "k string, capture_time timestamp_ntz")
    assert [r[1] for r in rows_of(gap_groups(df, ["k"], 2), "capture_time", "group_id")] == [0, 0, 1]
