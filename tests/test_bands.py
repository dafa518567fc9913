import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators.bands import band_join
from footfall.operators.bitmaps import member_bitmaps, member_numbers, merged_counts


def pairs(spark, kind, left, right, low, high):
    a = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(left)], f"k string, t {kind}, i int")
    b = spark.createDataFrame([(k, t, j) for j, (k, t) in enumerate(right)], f"k string, u {kind}, j int")
    found = band_join(a, b, ["k"], "t", "u", low, high)
    assert found.columns == ["k", "t", "i", "u", "j"]
    return sorted((r.i, r.j) for r in found.collect())


def plain(left, right, low, high, seconds=False):
    gap = lambda t, u: (u - t).total_seconds() if seconds else u - t
    return sorted(
        (i, j) for i, (k, t) in enumerate(left) for j, (m, u) in enumerate(right)
        if k is not None and k == m and t is not None and u is not None and low <= gap(t, u) <= high
    )


@pytest.mark.parametrize("low, high", [(-3, 5), (0, 0), (2, 9), (-7, -7), (-0.5, 1.5)])
def test_against_all_pairs(spark, low, high):
    rng = random.Random(repr((low, high)))
    some = lambda n: [(rng.choice(["a", "a", "b", None]), rng.choice([None, *range(-20, 20)])) for _ in range(n)]
    left, right = some(60), some(80)
    assert pairs(spark, "long", left, right, low, high) == plain(left, right, low, high)
    left, right = ([(k, None if t is None else t / 4) for k, t in side] for side in (left, right))
    assert pairs(spark, "double", left, right, low, high) == plain(left, right, low, high)


def test_times(spark):
    rng = random.Random(1)
    start = datetime(1969, 12, 31, 23, 0)
    left, right = ([("a", start + timedelta(seconds=rng.randrange(7200), microseconds=rng.choice([0, 1, 999_999]))) for _ in range(50)] for _ in range(2))
    assert pairs(spark, "timestamp_ntz", left, right, -60, 60) == plain(left, right, -60, 60, seconds=True)
    left, right = ([("a", date(2024, 2, 1) + timedelta(days=rng.randrange(60))) for _ in range(30)] for _ in range(2))
    day = 86400
    assert pairs(spark, "date", left, right, -2 * day, 3 * day) == plain(left, right, -2 * day, 3 * day, seconds=True)


def test_a_hot_key_is_cut_along_time(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("t"))
        b = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").alias("u"))
        found = band_join(a, b, ["k"], "t", "u", -1, 1)
        assert found.count() == 3 * 20_000 - 2
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "_cell" in plan.split("SortMergeJoin")[1].split("\n")[0]
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_refused(spark):
    df = spark.createDataFrame([(1, 2)], "k int, t int")
    with pytest.raises(ValueError, match="empty"):
        band_join(df, df.withColumnRenamed("t", "u"), ["k"], "t", "u", 1, 0)
    with pytest.raises(ValueError, match="t"):
        band_join(df, df, ["k"], "t", "t", 0, 1)


def test_bitmaps_add_up(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(6), rng.choice(["x", "y"]), rng.choice([None, -5, 0, 10**15, *range(10**9, 10**9 + 40)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "day int, region string, id long")
    first = member_numbers(df.where("day < 2"), "id")
    more = member_numbers(df, "id", first)
    numbers = first.unionByName(more)
    assert sorted(r.number for r in numbers.collect()) == list(range(numbers.count()))
    assert member_numbers(df, "id", numbers).count() == 0
    daily = member_bitmaps(df, ["day", "region"], "id", numbers)
    for keys in (["day", "region"], ["region"], ["day"]):
        want = df.groupBy(*keys).agg(F.count_distinct("id").alias("members"))
        assert sorted(map(tuple, merged_counts(daily, keys).collect())) == sorted(map(tuple, want.collect()))


def test_many_members_need_several_buckets(spark):
    df = spark.range(100_000).select((F.col("id") * 7_919_000_003).alias("id"), (F.col("id") % 2).alias("day"))
    daily = member_bitmaps(df, ["day"], "id", member_numbers(df, "id"))
    assert daily.count() <= 10 and merged_counts(daily.withColumn("all", F.lit(1)), ["all"]).first().members == 100_000
