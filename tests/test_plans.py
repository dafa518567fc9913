"""What the physical plans must and must not contain."""

import os
import re
import sys
from datetime import date

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from footfall.operators.counting import count_members  # noqa: E402
from footfall.operators.detail import visit_detail  # noqa: E402
from footfall.operators.groups import arrival_groups  # noqa: E402
from footfall.operators.heatmap import path_heatmap  # noqa: E402
from footfall.operators.demographics import demographics  # noqa: E402
from footfall.operators.returning import new_or_return  # noqa: E402
from footfall.operators.stay import stay_time, stay_time_segments  # noqa: E402
from footfall.operators.visitation import hourly_visitation  # noqa: E402
from footfall.plans.catalogue import captures  # noqa: E402
from footfall.plans.refresh import refresh  # noqa: E402
from footfall.sources.captures import read_captures  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("captures") / "c")
    captures(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def tables_of(captures, detail, stay, flags, groups):
    return {
        "visit_detail": lambda: visit_detail(captures),
        "arrival_groups": lambda: arrival_groups(captures, 11),
        "stay_time": lambda: stay_time(detail),
        "stay_time_segments": lambda: stay_time_segments(captures),
        "new_or_return": lambda: new_or_return(stay),
        "hourly_visitation": lambda: hourly_visitation(detail, groups, stay, flags),
        "demographics": lambda: demographics(detail, stay, flags),
        **{f"heatmap_{m}": (lambda m=m: path_heatmap(captures, m)) for m in ("boundary", "elapsed", "fractional")},
    }


@pytest.fixture(scope="module")
def operators(spark, stored, tmp_path_factory):
    """Each operator on stored inputs, so that its plan is its own."""
    base = tmp_path_factory.mktemp("inputs")

    def keep(df, name):
        df.write.parquet(str(base / name))
        return spark.read.parquet(str(base / name))

    detail = keep(visit_detail(stored), "detail")
    stay = keep(stay_time(detail), "stay")
    return tables_of(stored, detail, stay, keep(new_or_return(stay), "flags"), keep(arrival_groups(stored, 11), "groups"))


OPERATORS = sorted(tables_of(*[None] * 5))


@pytest.mark.parametrize("name", OPERATORS)
def test_no_operator_funnels_or_multiplies_rows(operators, no_broadcast, name):
    text = plan(operators[name]())
    assert "FileScan parquet" in text
    for bad in ("CartesianProduct", "NestedLoopJoin", "SinglePartition", "Python", "Pandas"):
        assert bad not in text, bad


@pytest.mark.parametrize("name", OPERATORS)
def test_no_broadcast_is_forced(operators, no_broadcast, name):
    """With broadcasts of measured sides switched off, one that is left was asked for."""
    assert "Broadcast" not in plan(operators[name]())


def test_dates_prune_folders(spark, tmp_path):
    path = str(tmp_path / "by_date")
    rows = captures(spark, SF_DIR).withColumn("day", F.to_date("capture_time"))
    rows.write.partitionBy("day").parquet(path)
    df = read_captures(spark, path, [date(2024, 1, 2)], "day")
    scan = plan(df)
    assert re.search(r"PartitionFilters: \[[^\]]*day#\d+", scan) and "GreaterThanOrEqual(capture_time" in scan
    assert df.count() == rows.where("day = '2024-01-02'").count() > 0


def test_refresh_opens_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "by_date")
    captures(spark, SF_DIR).withColumn("day", F.to_date("capture_time")).write.partitionBy("day").parquet(path)
    spark.sql("CREATE DATABASE pruned")
    refresh(spark, read_captures(spark, path), [date(2024, 1, 2)], "pruned", only=["visit_detail"], date_column="day")
    assert {r.dt for r in spark.table("pruned.visit_detail").select("dt").collect()} == {date(2024, 1, 2)}


def test_heatmap_by_second_has_growing_frames_only(stored):
    for mode in ("elapsed", "fractional"):
        text = plan(path_heatmap(stored, mode))
        frames = re.findall(r"specifiedwindowframe\(RangeFrame, ([^,]*), ", text)
        assert frames and set(frames) == {"unboundedpreceding$()"}, set(frames)


def test_detail_reduces_before_it_shuffles(stored):
    text = plan(visit_detail(stored))
    assert text.count("Exchange hashpartitioning") == 2
    # Read bottom up: scan, group limit, shuffle by second and region, shuffle by day.
    assert re.search(r"Window.*Exchange.*row_number\(\), 1, Final.*Exchange.*row_number\(\), 1, Partial.*FileScan", text, re.S)


def test_heatmap_by_minute_has_two_shuffles_and_no_join(stored):
    text = plan(path_heatmap(stored, "boundary"))
    assert text.count("Exchange hashpartitioning") == 2 and "Join" not in text
    assert "camera_id" not in text and "person_id" not in text


def test_groups_push_the_camera_down(stored):
    text = plan(arrival_groups(stored, 11))
    assert "EqualTo(camera_id,11)" in text
    assert "row_number(), 1, Partial" in text


def test_segments_sort_no_raw_captures(stored):
    text = plan(stay_time_segments(stored))
    assert "SortAggregate" not in text
    assert "row_number(), 1, Partial" in text  # reduced before the first shuffle


def test_counts_do_not_expand_rows(stored):
    df = count_members(stored, ["region_id"], "profile_id", {"a": None, "b": F.col("age") > 30})
    text = plan(df)
    assert "Expand" not in text and text.count("partial_max") > 0
