"""Daily refresh of the derived tables for a list of dates."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.functions import clock
from footfall.operators.demographics import demographics
from footfall.operators.detail import visit_detail
from footfall.operators.groups import ENTRANCE_CAMERA, arrival_groups
from footfall.operators.heatmap import path_heatmap
from footfall.operators.returning import new_or_return
from footfall.operators.stay import stay_time
from footfall.operators.visitation import hourly_visitation
from footfall.sources.captures import on_dates
from footfall.sources.scratch import cleared, stored
from footfall.sources.tables import DATE_PARTITION, LOAD_TIME, buckets_of, overwrite_dates

TABLES = [
    "visit_detail", "arrival_groups", "stay_time", "new_or_return",
    "hourly_visitation", "demographics", "path_heatmap",
]


#: Table: what it is made from. ``lookback`` adds the dates that a visitor of a date can have returned from.
SOURCES = {
    "visit_detail": ["captures"], "arrival_groups": ["captures"], "path_heatmap": ["captures"],
    "stay_time": ["visit_detail"], "new_or_return": ["stay_time", "stay_time lookback"],
    "hourly_visitation": ["visit_detail", "arrival_groups", "stay_time", "new_or_return"],
    "demographics": ["visit_detail", "stay_time", "new_or_return"],
}
DIGEST = "capture_digest"
VISITOR = "profile_id"
#: Captures of a bucket when its tables are created, on average.
BUCKET_CAPTURES = 500_000


@dataclass(frozen=True)
class Settings:
    camera_id: int = ENTRANCE_CAMERA
    gap_s: int = 2
    zone_lookback_months: int = 2
    day_lookback: int = 1
    heatmap_mode: str = "elapsed"
    #: Tables with visitors are created with so many buckets by visitor, and joined without a shuffle where
    #: ``spark.sql.requireAllClusterKeysForCoPartition`` is off. There are more where the first refresh has more
    #: than ``BUCKET_CAPTURES`` a bucket, as a bucket is read by one task. A bucket of a date should be some 100 MB.
    buckets: int = 0


def refresh(
    spark: SparkSession,
    captures: DataFrame,
    dates: Iterable[date],
    database: str = "default",
    settings: Settings = Settings(),
    only: Iterable[str] = TABLES,
    date_column: str | None = None,
) -> list[str]:
    """Rebuild ``dates`` in the derived tables; other dates stay as they are.

    All dates go through one plan per table. Each table is written and read back
    before the next one uses it, which also cuts the lineage. ``only`` picks the
    tables to rebuild from what is stored. ``date_column`` is the date that the
    captures are partitioned by, if they are: other dates are then not opened.
    """
    days = sorted(set(dates))
    todays = on_dates(captures, "capture_time", days, date_column)
    if LOAD_TIME in todays.columns:
        todays = todays.drop(LOAD_TIME)

    def read(name: str, when: Iterable[date] = days) -> DataFrame:
        stored = spark.table(f"{database}.{name}")
        return stored.where(F.col(DATE_PARTITION).isin(sorted(set(when)))).drop(DATE_PARTITION, LOAD_TIME)

    # Table: how to make its rows, and the date of a row.
    jobs = {
        "visit_detail": (lambda: visit_detail(todays), F.to_date("capture_time")),
        "arrival_groups": (
            lambda: arrival_groups(todays, settings.camera_id, settings.gap_s),
            F.to_date("date_hour"),
        ),
        "stay_time": (lambda: stay_time(read("visit_detail")), F.col("date")),
        "new_or_return": (
            lambda: new_or_return(
                read("stay_time"),
                read("stay_time", _lookback_dates(spark, days, settings)),
                settings.zone_lookback_months,
                settings.day_lookback,
            ),
            F.col("date"),
        ),
        "hourly_visitation": (
            lambda: hourly_visitation(
                read("visit_detail"), read("arrival_groups"), read("stay_time"), read("new_or_return")
            ),
            F.to_date("date_hour"),
        ),
        "demographics": (
            lambda: demographics(read("visit_detail"), read("stay_time"), read("new_or_return")),
            F.col("date"),
        ),
        "path_heatmap": (lambda: path_heatmap(todays, settings.heatmap_mode), F.col("date")),
    }
    done = []
    buckets = _buckets(spark, todays, database, settings)
    for name in TABLES:
        if name in set(only):
            rows, day = jobs[name]
            made = rows()
            cut = (VISITOR, buckets) if buckets and VISITOR in made.columns else None
            overwrite_dates(made, f"{database}.{name}", days, day, cut)
            done.append(f"{database}.{name}")
    return done


def _buckets(spark: SparkSession, captures: DataFrame, database: str, settings: Settings) -> int:
    """Buckets for tables to come: as many as those have that are there, so that all are joined where they lie."""
    if not settings.buckets:
        return 0
    there = (buckets_of(spark, f"{database}.{name}") for name in TABLES if spark.catalog.tableExists(f"{database}.{name}"))
    for cut in there:
        if cut:
            return cut[1]
    return max(settings.buckets, math.ceil(captures.count() / BUCKET_CAPTURES))


def _lookback_dates(spark: SparkSession, days: list[date], settings: Settings) -> set[date]:
    """Calendar dates whose stays can make a visitor of ``days`` a returning one.

    A business date starts on its calendar date and ends on the next one.
    """
    given = spark.createDataFrame([(d,) for d in days], "d date")
    shifted = given.select(
        clock.months_before(F.col("d"), settings.zone_lookback_months),
        clock.days_before(F.col("d"), settings.day_lookback),
    ).collect()
    dates = {d for row in shifted for d in row}
    return dates | {row[1] + timedelta(days=1) for row in shifted}


def refresh_changed(
    spark: SparkSession,
    captures: DataFrame,
    database: str = "default",
    settings: Settings = Settings(),
    only: Iterable[str] = TABLES,
    date_column: str | None = None,
    among: Iterable[date] | None = None,
) -> dict[str, list[date]]:
    """Rebuild what the changes in ``captures`` since the last call reach; returns the dates remade in each table.

    Changed dates, new and vanished ones included, are found by a digest of the rows of a
    date, kept in a table. A date is remade in a table if its rows changed in one of the
    tables or dates that the table is made from, and in no other case. ``only`` must name
    the tables that its tables are made from too, and be the same in each call. ``among`` limits
    the dates that are looked at, else all captures are read once. The digests are stored
    at last: a call that was cut short is made good by the next one.
    """
    wanted = [name for name in TABLES if name in set(only)]
    lacking = {s.split()[0] for name in wanted for s in SOURCES[name]} - {"captures", *wanted}
    if lacking:
        raise ValueError(f"{sorted(lacking)} have to be refreshed too")
    looked_at = None if among is None else sorted(set(among))
    rows = captures if looked_at is None else on_dates(captures, "capture_time", looked_at, date_column)
    with cleared():
        now = stored(date_digests(rows), "digests")
        changed = _changed(now, f"{database}.{DIGEST}", looked_at)
        have = {r[0] for r in now.select("day").collect()}
        if looked_at is not None and spark.catalog.tableExists(f"{database}.{DIGEST}"):
            have |= {r[0] for r in spark.table(f"{database}.{DIGEST}").select(DATE_PARTITION).distinct().collect()}
        dirty = _reached(spark, changed, settings)
        done = {}
        for name in wanted:
            # Without captures a date has no rows; it is remade only to be emptied.
            days = sorted(d for d in dirty[name] if d in have or d in changed)
            if days:
                refresh(spark, captures, days, database, settings, [name], date_column)
            done[name] = days
        if changed:
            overwrite_dates(now, f"{database}.{DIGEST}", changed, F.col("day"))
    return done


def date_digests(captures: DataFrame) -> DataFrame:
    """Per date the number of rows and two sums over their hashes that any change alters, whatever the order."""
    columns = sorted(c for c in captures.columns if c != LOAD_TIME)
    mark = F.xxhash64(*(F.col(f"`{c}`") for c in columns))
    # A null hashes like nothing: which columns are null is part of the row.
    nulls = F.concat_ws("", *(F.col(f"`{c}`").isNull().cast("int").cast("string") for c in columns))
    rows = captures.where("capture_time IS NOT NULL").select(F.to_date("capture_time").alias("day"), mark.alias("_mark"), F.xxhash64(nulls, mark).alias("_other"))
    high = F.shiftright("_other", 32).cast("decimal(38,0)")
    return rows.groupBy("day").agg(F.count("*").alias("rows"), F.bit_xor("_mark").alias("mark"), F.sum(high).alias("total"))


def _changed(now: DataFrame, table: str, looked_at: list[date] | None) -> set[date]:
    """Dates whose digests differ from the stored ones: as many as dates, and only those that differ."""
    spark = now.sparkSession
    if not spark.catalog.tableExists(table):
        return {r[0] for r in now.select("day").collect()}
    before = spark.table(table).select("day", *(F.col(c).alias(f"_{c}") for c in ("rows", "mark", "total")))
    if looked_at is not None:
        before = before.where(F.col("day").isin(looked_at))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("rows", "mark", "total")]
    differ = now.join(before, "day", "full").where(~(same[0] & same[1] & same[2]))
    return {r[0] for r in differ.select("day").collect()}


def _reached(spark: SparkSession, changed: set[date], settings: Settings) -> dict[str, set[date]]:
    """Dates of each table that read a changed date, directly or through other tables."""
    dirty = {"captures": set(changed)}
    for name in TABLES:
        dirty[name] = set()
        for source in SOURCES[name]:
            table, _, lookback = source.partition(" ")
            dirty[name] |= _readers(spark, dirty[table], settings) if lookback else dirty[table]
    return dirty


def _readers(spark: SparkSession, days: set[date], settings: Settings) -> set[date]:
    """Dates whose visitors can have returned from ``days``: the inverse of ``_lookback_dates``."""
    if not days:
        return set()
    furthest = max(settings.day_lookback, 31 * settings.zone_lookback_months + 3)
    given = spark.createDataFrame([(d,) for d in sorted(days)], "d date")
    near = given.select("d", F.explode(F.sequence(F.lit(0), F.lit(furthest))).alias("n")).select("d", F.date_add("d", F.col("n")).alias("x"))
    back = clock.days_before(F.col("x"), settings.day_lookback)
    reads = (clock.months_before(F.col("x"), settings.zone_lookback_months) == F.col("d")) | (back == F.col("d")) | (F.date_add(back, 1) == F.col("d"))
    return {r[0] for r in near.where(reads).select("x").distinct().collect()}
