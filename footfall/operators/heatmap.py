"""Path heatmap: where visitors were up to an hour before and after each capture.

For every capture (the base) and every offset bin, the region of the nearest
capture of the same visitor and day that falls into the bin.

The obvious plan joins a visitor's day with itself and keeps the nearest pair
per bin, which is quadratic in the captures of a visitor. Here no pairs are
built. Captures are first reduced to one entry per second, or per minute where
the bins count minutes. By minute, at most 1,440 entries long, a bin is a range
frame around the current entry. By second a bin is an as-of lookup: the last
entry up to its near edge, from either side, tested against its far edge. Such
a frame only grows, so the work is in proportion to the entries. A visitor's day
is cut into blocks of two hours, each with an hour of neighbours on both sides,
so no task holds a crowded day.

The arrays exploded here are never empty. ``explode_outer`` is used as ``explode``
makes Spark add a filter on their size, which computes each array twice.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from footfall.functions import clock
from footfall.functions.buckets import OFFSET_RANGES, age_range
from footfall.operators.ordered import top_rows

VISITOR_DAY = ["date", "profile_id"]
# Seconds that a bin reaches at most, and seconds in a block of a visitor's day.
REACH = 3600
BLOCK = 2 * REACH
# Entries of a task: one takes some kilobytes once it has all its bins.
ENTRIES = 100_000


def path_heatmap(captures: DataFrame, mode: str = "boundary") -> DataFrame:
    """Offset bins per base capture. The modes differ at the edges of the bins.

    ``boundary``: minutes are minute boundaries crossed; equal base captures give
    one set of rows; attributes are those of the base capture.
    ``elapsed``: whole elapsed minutes, rounded down; one set of rows per base
    capture; another capture in the very same second is in bin 5, not 0;
    attributes are those of the visitor's first capture of the day.
    ``fractional``: exact elapsed time; one set of rows per base capture; no
    attributes.
    """
    operators = {"boundary": _by_minute, "elapsed": _by_elapsed_minute, "fractional": _by_second}
    if mode not in operators:
        raise ValueError(f"unknown mode {mode!r}")
    usable = captures.where("capture_time is not null and profile_id is not null").withColumn(
        "date", F.to_date("capture_time")
    )
    return operators[mode](usable)


def _by_minute(captures: DataFrame) -> DataFrame:
    variants = F.struct("region_name", "member_tier", age_range(F.col("age")).alias("age_range"), "gender")
    per_second = captures.groupBy(*VISITOR_DAY, "capture_time").agg(
        F.min_by(F.struct("region_name"), "capture_id").alias("at"),
        F.collect_set(variants).alias("bases"),
    )
    # At most 60 entries per minute and 1,440 minutes per visitor and day.
    minutes = (
        per_second.repartition(*VISITOR_DAY)
        .withColumn("minute", clock.minute_of_day(F.col("capture_time")))
        .groupBy(*VISITOR_DAY, "minute")
        .agg(F.sort_array(F.collect_list(F.struct("capture_time", "at", "bases"))).alias("seconds"))
        .withColumn("at", F.col("seconds")[0]["at"])
    )
    frames = dict(OFFSET_RANGES["boundary"])
    frames[5] = (1, frames[5][1])
    w = Window.partitionBy(*VISITOR_DAY).orderBy("minute")
    nearest = _nearest("at", frames, w)
    entries = (
        minutes.withColumns({_name(b): at for b, at in nearest.items()})
        .withColumn("second", F.explode_outer("seconds"))
        .withColumn("base", F.explode_outer("second.bases"))
    )
    # The rest of the own minute is in bin 5: its first second, or its second
    # one seen from the first.
    first = F.col("seconds")[0]
    own_minute = F.when(F.col("second.capture_time") != first["capture_time"], first["at"]).otherwise(
        F.get("seconds", F.lit(1))["at"]
    )
    at = {b: F.col(_name(b)) for b in nearest}
    at[0] = F.col("second.at")
    at[5] = F.coalesce(own_minute, at[5])
    return entries.withColumn("found", F.explode_outer(_found(at))).select(
        "date",
        clock.hour_label(F.col("second.capture_time")).alias("date_hour"),
        "profile_id",
        F.col("base.region_name").alias("region_name"),
        F.col("second.capture_time").alias("z0_time"),
        F.col("found.off_bin").alias("off_bin"),
        F.col("found.at.region_name").alias("area_at_off"),
        F.col("base.member_tier").alias("member_tier"),
        F.col("base.age_range").alias("age_range"),
        F.col("base.gender").alias("gender"),
    )


def _by_second(captures: DataFrame) -> DataFrame:
    timeline = (
        top_rows(captures, [*VISITOR_DAY, "capture_time"], [F.col("capture_id")])
        .withColumn("at", F.struct("region_name"))
        .withColumn("second", clock.second_of_day(F.col("capture_time")))
        .select(*VISITOR_DAY, "capture_time", "second", "at")
    )
    frames = OFFSET_RANGES["fractional"]
    named = _looked_up(timeline, frames, _tasks(captures)).where("own")
    at = {0: F.col("at"), **{b: F.col(_name(b))["at"] for b in frames}}
    found = named.select("profile_id", "capture_time", _found(at).alias("offsets"))
    return (
        captures.select("date", "profile_id", "region_name", "capture_time")
        .join(found, ["profile_id", "capture_time"])
        .withColumn("found", F.explode_outer("offsets"))
        .select(
            "date", "profile_id", "region_name", F.col("capture_time").alias("z0_time"),
            F.col("found.off_bin").alias("off_bin"),
            F.col("found.at.region_name").alias("area_at_off"),
        )
    )


def _by_elapsed_minute(captures: DataFrame) -> DataFrame:
    second_key = [*VISITOR_DAY, "capture_time"]
    traits = F.struct("member_tier", age_range(F.col("age"), unknown="").alias("age_range"), "gender")
    first_two = top_rows(captures, second_key, [F.col("capture_id")], n=2)
    runner_up = F.lead(F.struct("region_name")).over(Window.partitionBy(*second_key).orderBy("capture_id"))
    timeline = (
        first_two.withColumn("runner_up", runner_up)
        .where("rn = 1")
        .select(
            *second_key,
            F.col("capture_id").alias("first_id"),
            F.struct("region_name").alias("at"),
            "runner_up",
            clock.second_of_day(F.col("capture_time")).alias("second"),
        )
    )
    frames = {b: (60 * low, 60 * high + 59) for b, (low, high) in OFFSET_RANGES["elapsed"].items()}
    frames[5] = (1, frames[5][1])
    named = _earliest_of_minute(_looked_up(timeline, frames, _tasks(captures)), [b for b in frames if b < 0])
    at = {b: F.col(_name(b))["at"] for b in frames}
    found = named.select(
        "profile_id", "capture_time", "first_id", "runner_up",
        F.col("at").alias("first_at"), _found(at).alias("offsets"),
        at[5].alias("next_at"),
    )
    # Attributes are those of the first capture of the day.
    seen = captures.groupBy(*VISITOR_DAY).agg(F.min_by(traits, F.struct("capture_time", "capture_id")).alias("traits"))
    # Bin 0 is the base itself; bin 5 may be another capture of its second.
    same_second = F.when(F.col("capture_id") != F.col("first_id"), F.col("first_at")).otherwise(F.col("runner_up"))
    own = {0: F.struct("region_name"), 5: F.coalesce(same_second, F.col("next_at"))}
    others = F.filter("offsets", lambda o: o["off_bin"] != 5)
    return (
        captures.select("date", "profile_id", "capture_id", "region_name", "capture_time")
        .join(found, ["profile_id", "capture_time"])
        .join(seen, VISITOR_DAY)
        .withColumn("found", F.explode_outer(F.concat(_found(own), others)))
        .select(
            "date",
            clock.hour_label(F.col("capture_time")).alias("date_hour"),
            "profile_id", "region_name", F.col("capture_time").alias("z0_time"),
            F.col("found.off_bin").alias("off_bin"),
            F.col("found.at.region_name").alias("area_at_off"),
            "traits.member_tier", "traits.age_range", "traits.gender",
        )
    )


def _tasks(captures: DataFrame) -> int | None:
    """Tasks for the blocks of ``captures``, by their number; none where the cores have few enough each.

    Spark merges partitions by the bytes that are shuffled, here a fiftieth of what the bins take.
    """
    rows, cores = captures.count(), captures.sparkSession.sparkContext.defaultParallelism
    return math.ceil(rows / ENTRIES) if rows > ENTRIES * cores else None


def _looked_up(timeline: DataFrame, frames: dict[int, tuple[int, int]], tasks: int | None) -> DataFrame:
    """The timeline in blocks, dealt to ``tasks``, with the nearest entry in each frame of seconds.

    An entry is in its own block (``own``) and as a neighbour in the closer one
    of the blocks around. Columns ``bin_..`` are structs of ``second``, ``at`` and
    ``before``, the second of the entry before that one.
    """
    block = clock.truncating_div(F.col("second"), BLOCK)
    aside = F.when(F.col("second") % BLOCK >= REACH, block + 1).otherwise(block - 1)
    copies = F.array(F.struct(block.alias("block"), F.lit(True).alias("own")), F.struct(aside.alias("block"), F.lit(False).alias("own")))
    placed = timeline.withColumn("_copy", F.explode_outer(copies)).select("*", "_copy.*").drop("_copy")
    if tasks:
        placed = placed.repartition(tasks, *VISITOR_DAY, "block")
    part = Window.partitionBy(*VISITOR_DAY, "block")
    onward, back = part.orderBy("second"), part.orderBy(F.col("second").desc())
    placed = placed.withColumn("here", F.struct("second", "at", F.lag("second").over(onward).alias("before")))

    def nearest(low: int, high: int) -> Column:
        # In descending order "up to" an offset means at least that many seconds later.
        if low > 0:
            entry = F.last("here").over(back.rangeBetween(Window.unboundedPreceding, -low))
            return F.when(entry["second"] <= F.col("second") + high, entry)
        entry = F.last("here").over(onward.rangeBetween(Window.unboundedPreceding, high))
        return F.when(entry["second"] >= F.col("second") + low, entry)

    return placed.withColumns({_name(b): nearest(low, high) for b, (low, high) in frames.items()})


def _earliest_of_minute(named: DataFrame, bins: list[int]) -> DataFrame:
    """Own entries, with the earliest entry of the whole minute in place of the nearest one.

    Looking back, captures at the same whole-minute distance tie and the
    earliest wins. Where the minute may hold an earlier entry, its start becomes
    a probe in the timeline, and finds the next entry from there on.
    """
    probes = []
    for b in bins:
        found = F.col(_name(b))
        start = F.col("second") + 60 * clock.flooring_div(found["second"] - F.col("second"), 60)
        probe = F.struct(start.alias("position"), F.lit(b).alias("bin"))
        probes.append(F.when(F.col("own") & (found["before"] >= start), probe))
    # Entries come before probes of their second: position descending, then bin null first.
    entry = F.struct(F.col("second").alias("position"), F.lit(None).cast("int").alias("bin"))
    rows = named.withColumn("_row", F.explode_outer(F.filter(F.array(entry, *probes), lambda p: p.isNotNull())))
    order = Window.partitionBy(*VISITOR_DAY, "block").orderBy(F.col("_row.position").desc(), F.col("_row.bin").asc_nulls_first())
    next_at = F.last(F.when(F.col("_row.bin").isNull(), F.col("at")), ignorenulls=True)
    rows = rows.withColumn("_at", next_at.over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))).where("own")
    probed = F.collect_list(F.when(F.col("_row.bin").isNotNull(), F.struct("_row.bin", F.col("_at").alias("at"))))
    base = F.first(F.when(F.col("_row.bin").isNull(), F.struct(*[c for c in named.columns if c not in (*VISITOR_DAY, "block", "second")])), ignorenulls=True)
    whole = rows.groupBy(*VISITOR_DAY, "block", "second").agg(base.alias("_base"), F.map_from_entries(probed).alias("_probed"))
    whole = whole.select(*VISITOR_DAY, "second", "_base.*", "_probed")
    better = {
        _name(b): F.when(F.col(_name(b)).isNotNull(), F.struct(F.coalesce(F.col("_probed")[b], F.col(_name(b))["at"]).alias("at")))
        for b in bins
    }
    return whole.withColumns(better)


def _name(offset: int) -> str:
    return f"bin_{offset}"


def _nearest(entry: str, frames: dict[int, tuple[int, int]], w: WindowSpec) -> dict[int, Column]:
    """Nearest entry per bin: the first after the current one or the last before."""
    return {
        b: (F.first if b > 0 else F.last)(entry).over(w.rangeBetween(low, high))
        for b, (low, high) in frames.items()
    }


def _found(at: dict[int, Column]) -> Column:
    """Array of (off_bin, at) for the bins that hold a capture."""
    entries = [F.struct(F.lit(b).alias("off_bin"), at[b].alias("at")) for b in sorted(at)]
    return F.filter(F.array(*entries), lambda e: e["at"].isNotNull())
