import os
import sys
from datetime import date

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import captures, rows_of  # noqa: E402

from footfall.plans.refresh import TABLES, Settings, refresh  # noqa: E402

D1, D2 = date(2024, 3, 5), date(2024, 3, 6)
ROWS = [
    (1, "05:30:00", 1), (1, "07:10:00", 2), (2, "08:00:00", 1), (2, "08:00:01", 2),
    (1, "09:00:00", 1, {"day": "2024-03-06"}), (2, "09:30:00", 2, {"day": "2024-03-06"}),
]


def content(spark, db):
    return {
        t: sorted((tuple(r) for r in spark.table(f"{db}.{t}").drop("batch_time").collect()), key=repr) for t in TABLES
    }


def test_refresh_is_idempotent_and_date_by_date(spark):
    spark.sql("CREATE DATABASE whole")
    spark.sql("CREATE DATABASE daily")
    df = captures(spark, ROWS).withColumn("batch_time", F.current_timestamp())
    done = refresh(spark, df, [D1, D2], "whole")
    assert done == [f"whole.{t}" for t in TABLES]
    first = content(spark, "whole")
    assert all(first.values())
    refresh(spark, df, [D1, D2], "whole")
    assert content(spark, "whole") == first
    # One date at a time gives the same: day two looks back on the stored day one.
    refresh(spark, df, [D1], "daily")
    refresh(spark, df, [D2], "daily")
    assert content(spark, "daily") == first
    flags = spark.table("daily.new_or_return").where(F.col("dt") == F.lit(D2))
    assert rows_of(flags, "profile_id", "region_id", "is_return_casino") == [(1, 1, 0), (2, 2, 1)]


def test_counts_hold_together(spark):
    stay, flags = spark.table("whole.stay_time"), spark.table("whole.new_or_return")
    assert stay.count() == flags.count()
    assert spark.table("whole.hourly_visitation").count() >= spark.table("whole.visit_detail").count()


def test_dates_without_captures_end_up_empty(spark):
    spark.sql("CREATE DATABASE emptied")
    df = captures(spark, ROWS)
    refresh(spark, df, [D1, D2], "emptied")
    refresh(spark, df.where("capture_time < '2024-03-06'"), [D1, D2], "emptied")
    for t in TABLES:
        days = {r.dt for r in spark.table(f"emptied.{t}").select("dt").collect()}
        assert days == {D1}, t


def test_one_table_alone(spark):
    df = captures(spark, ROWS)
    assert refresh(spark, df, [D1, D2], "whole", Settings(heatmap_mode="boundary"), only=["path_heatmap"]) == [
        "whole.path_heatmap"
    ]
