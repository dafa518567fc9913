"""The capture table: its schema, reading it, and picking dates from it."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.functions import clock

# Columns the operators read. Others (person, member, album, address, ..) pass
# through. capture_time has second grain; capture_id makes rows unique and
# breaks ties in time.
REQUIRED = T.StructType(
    [
        T.StructField("capture_id", T.LongType()),
        T.StructField("profile_id", T.LongType()),
        T.StructField("profile_type", T.IntegerType()),
        T.StructField("member_tier", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("gender", T.IntegerType()),
        T.StructField("region_id", T.LongType()),
        T.StructField("region_name", T.StringType()),
        T.StructField("camera_id", T.LongType()),
        T.StructField("capture_time", T.TimestampNTZType()),
    ]
)


def conform(captures: DataFrame) -> DataFrame:
    """Cast to the capture schema: long ids, naive times on whole seconds."""
    missing = [f.name for f in REQUIRED if f.name not in captures.columns]
    if missing:
        raise ValueError(f"captures lack the columns {missing}")
    cast = {f.name: F.col(f.name).cast(f.dataType) for f in REQUIRED}
    cast["capture_time"] = clock.second_floor(cast["capture_time"])
    return captures.withColumns(cast)


def read_captures(
    spark: SparkSession, path: str, dates: Iterable[date] | None = None, date_column: str | None = None
) -> DataFrame:
    """Captures of ``dates``. ``date_column`` is the date that the files are partitioned by, if they are."""
    captures = spark.read.parquet(path)
    if dates is not None:
        captures = on_dates(captures, "capture_time", dates, date_column)
    return conform(captures)


def in_dates(ts: Column, dates: Iterable[date]) -> Column:
    """``ts`` falls on one of ``dates``, as ranges a Parquet scan can skip by.

    Neighbouring dates share a range, so a month is one comparison pair.
    """
    spans: list[list[date]] = []
    for day in sorted(set(dates)):
        if spans and day == spans[-1][1]:
            spans[-1][1] = day + timedelta(days=1)
        else:
            spans.append([day, day + timedelta(days=1)])
    tests = [
        (ts >= F.lit(str(start)).cast("timestamp_ntz")) & (ts < F.lit(str(end)).cast("timestamp_ntz"))
        for start, end in spans
    ]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def on_dates(df: DataFrame, time_col: str, dates: Iterable[date], date_column: str | None = None) -> DataFrame:
    """Rows of ``dates``: by ranges of ``time_col``, and by folders where ``date_column`` names the partition."""
    days = sorted(set(dates))
    if date_column is not None:
        df = df.where(F.col(date_column).isin(days))
    return df.where(in_dates(F.col(time_col), days))


def captures_from_events(events: DataFrame, faster: int = 10, slower: int = 1) -> DataFrame:
    """View an event log as captures: event types are zones, users are visitors.

    Time is compressed tenfold from 2024-01-01, which makes 30 days of events
    into three dense days of captures; ``faster`` 1 and ``slower`` 3 stretch them
    over three months. Every third capture is moved to a full quarter of an hour, so
    that some share a second, and of every fifth visitor attributes change and are
    sometimes unknown.
    """
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    user, event = F.col("user_id"), F.col("event_id")
    moved = clock.truncating_div(clock.elapsed_seconds(start, F.col("ts")), faster) * slower
    seconds = F.when(event % 3 == 0, moved - moved % 900).otherwise(moved)
    varied = user % 5 == 3
    region = F.lit(5)
    for number, kind in enumerate(["click", "error", "purchase", "signup"], start=1):
        region = F.when(F.col("event_type") == kind, number).otherwise(region)
    level = F.when(varied, user + event).otherwise(user)
    tier = F.when(varied & (event % 7 == 0), None).when(level % 4 != 0, "").otherwise(F.concat(F.lit("T"), (level % 16).cast("string")))
    age = F.when(~varied | (event % 6 != 0), 15 + (user * 7 + F.when(varied, event % 4 * 13).otherwise(0)) % 60)
    gender = F.when(~varied | (event % 9 != 0), 1 + clock.truncating_div(user, 4) % 2)
    return events.select(
        F.col("event_id").alias("capture_id"),
        user.alias("profile_id"),
        F.concat(F.lit("P"), user.cast("string")).alias("person_id"),
        (1 + user % 4).cast("int").alias("profile_type"),
        tier.alias("member_tier"),
        age.cast("int").alias("age"),
        gender.cast("int").alias("gender"),
        region.cast("long").alias("region_id"),
        F.concat(F.lit("Zone "), "event_type").alias("region_name"),
        (10 * region + 1 + F.col("event_id") % 5).cast("long").alias("camera_id"),
        (start + F.expr("INTERVAL '1' SECOND") * seconds).alias("capture_time"),
    )
