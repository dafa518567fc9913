"""Path heatmap against a direct reading of its rule, pair by pair."""

import os
import random
import sys
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import at, captures, rows_of  # noqa: E402

from footfall.functions.buckets import OFFSET_RANGES  # noqa: E402
from footfall.operators import heatmap  # noqa: E402
from footfall.operators.heatmap import path_heatmap  # noqa: E402

AGES = [(0, 20, "0-20"), (21, 39, "21-39"), (40, 65, "40-65"), (66, 999, "65+")]


def age_label(age, unknown):
    return next((label for low, high, label in AGES if age is not None and low <= age <= high), unknown)


def rule(rows, mode):
    """All pairs of a visitor's day; the nearest, then earliest, then lowest id per bin."""
    days = defaultdict(list)
    for r in rows:
        if r.profile_id is not None:
            days[r.profile_id, r.capture_time.date()].append(r)
    out = []
    for (profile, day), group in days.items():
        group.sort(key=lambda r: (r.capture_time, r.capture_id))
        for base in group:
            best = {}
            for other in group:
                secs = int((other.capture_time - base.capture_time).total_seconds())
                if mode == "boundary":
                    floor = lambda t: t.replace(second=0)
                    d = int((floor(other.capture_time) - floor(base.capture_time)).total_seconds()) // 60
                    own = secs == 0
                elif mode == "elapsed":
                    d, own = secs // 60, other is base
                else:
                    d, own = secs, secs == 0
                bins = [0] if own else [b for b, (lo, hi) in OFFSET_RANGES[mode].items() if lo <= d <= hi]
                for b in bins:
                    rank = (abs(d), other.capture_time, other.capture_id)
                    if b not in best or rank < best[b][0]:
                        best[b] = (rank, other.region_name)
            for b, (_, there) in best.items():
                key = (day, profile, base.region_name, base.capture_time, b, there)
                if mode == "fractional":
                    out.append(key)
                else:
                    who = base if mode == "boundary" else group[0]
                    label = age_label(who.age, None if mode == "boundary" else "")
                    out.append((*key, f"{base.capture_time:%H}:00", who.member_tier, label, who.gender))
    return sorted(set(out) if mode == "boundary" else out, key=repr)


COMMON = ["date", "profile_id", "region_name", "z0_time", "off_bin", "area_at_off"]
MORE = ["date_hour", "member_tier", "age_range", "gender"]


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for profile in range(12):
        # From crowded minutes with equal seconds to a day of rare captures.
        spread = [40, 90, 400, 3700, 9000, 86399][profile % 6]
        start = rng.randrange(0, 86400 - spread)
        for _ in range(rng.randrange(1, 40)):
            second = start + rng.randrange(0, spread + 1)
            rows.append(
                (
                    profile if profile else None,
                    at("00:00:00") + timedelta(seconds=second),
                    rng.randrange(1, 5),
                    {
                        "age": rng.choice([None, 10, 30, 50, 80]),
                        "member_tier": rng.choice(["", "Gold"]),
                        "gender": rng.choice([1, 2]),
                    },
                )
            )
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("mode", ["boundary", "elapsed", "fractional"])
@pytest.mark.parametrize("seed", range(4))
def test_against_all_pairs(spark, mode, seed):
    df = captures(spark, random_rows(seed)).repartition(3)
    columns = COMMON if mode == "fractional" else COMMON + MORE
    got = sorted((tuple(r) for r in path_heatmap(df, mode).select(*columns).collect()), key=repr)
    assert got == rule(df.collect(), mode)


@pytest.mark.parametrize("mode", ["elapsed", "fractional"])
def test_blocks_are_dealt_by_their_number(spark, monkeypatch, mode):
    """Many captures take more tasks, however few bytes are shuffled; the rows are the same."""
    df = captures(spark, random_rows(1)).repartition(3)
    before = sorted(map(repr, path_heatmap(df, mode).collect()))
    n = df.where("profile_id IS NOT NULL AND capture_time IS NOT NULL").count()
    monkeypatch.setattr(heatmap, "ENTRIES", 3)
    dealt = path_heatmap(df, mode)
    assert n > 3 * spark.sparkContext.defaultParallelism
    assert f", {-(-n // 3)}), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(repr, dealt.collect())) == before


def test_equal_base_captures(spark):
    df = captures(spark, [(1, "10:00:00", 1), (1, "10:00:00", 1)])
    assert path_heatmap(df, "boundary").count() == 1
    assert path_heatmap(df, "fractional").count() == 2
    assert rows_of(path_heatmap(df, "elapsed"), "off_bin") == [(0,), (0,), (5,), (5,)]


def test_does_not_cross_midnight(spark):
    df = captures(spark, [(1, "23:59:00", 1), (1, "00:01:00", 2, {"day": "2024-03-06"})])
    for mode in OFFSET_RANGES:
        assert rows_of(path_heatmap(df, mode), "off_bin") == [(0,), (0,)]


def test_no_pairs_are_built(spark):
    """A visitor seen every second for 20 minutes: results grow with rows, not with pairs."""
    times = spark.range(1200).select(
        F.col("id").alias("capture_id"), F.lit(1).cast("long").alias("profile_id"), F.lit(1).alias("profile_type"),
        F.lit("").alias("member_tier"), F.lit(30).alias("age"), F.lit(1).alias("gender"),
        (F.col("id") % 3).alias("region_id"), (F.col("id") % 3).cast("string").alias("region_name"),
        F.lit(94).cast("long").alias("camera_id"),
        (F.lit("2024-03-05 10:00:00").cast("timestamp_ntz") + F.expr("INTERVAL '1' SECOND") * F.col("id")).alias("capture_time"),
    )
    for mode in OFFSET_RANGES:
        result = path_heatmap(times, mode)
        assert result.count() <= 13 * 1200


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        path_heatmap(captures(spark, []), "other")
