import os
import sys
from datetime import date

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import captures  # noqa: E402

from footfall.operators.returning import new_or_return  # noqa: E402
from footfall.operators.visitation import hourly_visitation  # noqa: E402
from footfall.plans import refresh as plan  # noqa: E402
from footfall.plans.refresh import Settings, refresh  # noqa: E402
from footfall.sources.tables import DATE_PARTITION, LOAD_TIME, buckets_of  # noqa: E402

DAYS = [date(2024, 3, 5), date(2024, 3, 6)]
ROWS = [(p, f"{8 + p % 9:02d}:{m:02d}:00", m % 3, {"day": str(d)}) for d in DAYS for p in range(40) for m in (1, 7, 30)]


@pytest.fixture
def tables(spark):
    for key, value in {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.requireAllClusterKeysForCoPartition": "false"}.items():
        spark.conf.set(key, value)
    spark.sql("CREATE DATABASE IF NOT EXISTS cut")
    refresh(spark, captures(spark, ROWS), DAYS, "cut", Settings(buckets=4))
    yield lambda name: spark.table(f"cut.{name}").drop(DATE_PARTITION, LOAD_TIME)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")


def exchanges_below_joins(df):
    """Exchanges that feed a join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" +-:"))
    joins = [i for i, line in enumerate(lines) if "Join" in line]
    below = {j for i in joins for j in range(i + 1, len(lines)) if all(depth(x) > depth(lines[i]) for x in lines[i + 1 : j + 1])}
    return [lines[j].strip() for j in sorted(below) if "Exchange" in lines[j]], len(joins)


def test_visitor_tables_are_joined_where_they_lie(spark, tables):
    assert buckets_of(spark, "cut.stay_time") == ("profile_id", 4) and buckets_of(spark, "cut.demographics") is None
    stay, flags = tables("stay_time"), tables("new_or_return")
    found, joins = exchanges_below_joins(new_or_return(stay, stay))
    assert joins == 2 and not found, found
    hourly = hourly_visitation(tables("visit_detail"), tables("arrival_groups"), stay, flags)
    found, joins = exchanges_below_joins(hourly)
    assert joins >= 2 and not found, found


def test_same_rows_as_without_buckets(spark, tables):
    spark.sql("CREATE DATABASE IF NOT EXISTS uncut")
    df = captures(spark, ROWS)
    refresh(spark, df, DAYS, "uncut")
    refresh(spark, df, DAYS[:1], "cut", Settings(buckets=4))
    for name in ("visit_detail", "stay_time", "new_or_return", "hourly_visitation", "demographics"):
        one, other = (sorted(map(repr, spark.table(f"{db}.{name}").drop(LOAD_TIME).collect())) for db in ("cut", "uncut"))
        assert one == other and one, name
    files = spark.table("cut.stay_time").where(F.col("dt") == F.lit(DAYS[0])).select("_metadata.file_path").distinct().count()
    assert files <= 4
    stay = spark.table("uncut.stay_time").drop(DATE_PARTITION, LOAD_TIME)
    assert len(exchanges_below_joins(new_or_return(stay, stay))[0]) >= 2  # what buckets spare


def test_more_captures_have_more_buckets(spark, monkeypatch):
    monkeypatch.setattr(plan, "BUCKET_CAPTURES", 30)
    spark.sql("CREATE DATABASE IF NOT EXISTS many")
    df = captures(spark, ROWS)
    refresh(spark, df, DAYS, "many", Settings(buckets=4), only=["visit_detail"])
    monkeypatch.setattr(plan, "BUCKET_CAPTURES", 1)
    refresh(spark, df, DAYS, "many", Settings(buckets=4), only=["stay_time"])
    assert {buckets_of(spark, f"many.{name}") for name in ("visit_detail", "stay_time")} == {("profile_id", -(-len(ROWS) // 30))}


def test_buckets_are_shuffled_for_writing(spark, tables):
    """Rows that come in buckets go to tasks by date and bucket too; small files of stays and flags are not broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    hourly = hourly_visitation(tables("visit_detail"), tables("arrival_groups"), tables("stay_time"), tables("new_or_return"))
    flags = new_or_return(tables("stay_time"))
    for made in (hourly, flags):
        assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    files = spark.table("cut.hourly_visitation").select("dt", F.regexp_extract("_metadata.file_path", r"_(\d{5})\.", 1).alias("bucket"), "_metadata.file_path")
    assert files.groupBy("dt", "bucket").agg(F.count_distinct("file_path").alias("n")).where("n > 1").isEmpty()
