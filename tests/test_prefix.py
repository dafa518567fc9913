import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from footfall.operators import prefix
from footfall.operators.ordered import gap_groups


@pytest.fixture
def many_parts(spark):
    """More range partitions than AQE would leave."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_loops(spark, many_parts, seed):
    rng = random.Random(seed)
    keys = ["a"] * 20 + ["b", "c", None]
    rows = [(rng.choice(keys), rng.randrange(60), rng.choice([None, 1, 2, 5]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, t int, v int, id int")
    got = {(r.k, r.t): r.s for r in prefix.running_totals(df, ["k"], ["t"], {"s": F.col("v")}).collect()}
    want = {}
    for k, t, *_ in rows:
        known = [v for a, b, v, _ in rows if a == k and b <= t and v is not None]
        want[k, t] = sum(known) if known else None
    assert got == want
    places = {r.id: r.position for r in prefix.positions(df, ["k"], ["t", "id"]).collect()}
    assert places == {i: sum((b, j) < (t, i) for a, b, _, j in rows if a == k) for k, t, _, i in rows}
    numbers = {r.id: r.number for r in prefix.numbered(df, [F.col("t").desc(), "id"]).collect()}
    assert sorted(numbers.values()) == list(range(300))
    assert [r[3] for r in sorted(rows, key=lambda r: (-r[1], r[3]))] == sorted(numbers, key=numbers.get)


@pytest.mark.parametrize("first", [0, 1])
def test_bursts_are_those_of_one_window(spark, many_parts, first):
    rng = random.Random(first)
    start = datetime(2024, 3, 5)
    rows = [(rng.choice([1, 1, 1, 1, 2, 3]), start + timedelta(seconds=rng.randrange(4000))) for _ in range(500)]
    df = spark.createDataFrame(rows, "k int, capture_time timestamp_ntz")
    got = sorted(map(tuple, prefix.bursts(df, ["k"], "capture_time", 9, first).collect()))
    assert got == sorted(map(tuple, gap_groups(df, ["k"], 9, first).collect()))


def test_one_key_is_cut_over_all_tasks(spark, many_parts):
    df = spark.range(100_000).select(F.lit(1).alias("k"), "id", (F.col("id") % 7).alias("v"))
    sizes = [r[1] for r in prefix.dealt(df, ["k", "id"]).groupBy(prefix.PART).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 3 * sorted(sizes)[1]
    found = prefix.running_totals(df, ["k"], ["id"], {"s": F.col("v")})
    assert found.where("id = 99999").first().s == sum(i % 7 for i in range(100_000))
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Every window over the rows is by partition too; only offsets are ordered by key alone.
    assert plan.count("Window [") == 2 and f"windowspecdefinition({prefix.PART}" in plan


def test_empty_and_clashing(spark):
    none = spark.range(0).select(F.lit(1).alias("k"), "id")
    assert prefix.running_totals(none, ["k"], ["id"], {"s": F.col("id")}).count() == 0
    assert prefix.numbered(none, ["id"]).count() == 0
    odd = spark.range(3).select(F.col("id").alias("a.b"))
    assert sorted(r[1] for r in prefix.numbered(odd, ["`a.b`"]).collect()) == [0, 1, 2]
    with pytest.raises(ValueError, match=prefix.PART):
        prefix.dealt(spark.range(1).withColumn(prefix.PART, F.lit(0)), ["id"])
