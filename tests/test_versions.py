import os
import sys
from datetime import date

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import rows_of  # noqa: E402

from footfall.sources import versions  # noqa: E402

D = [date(2024, 3, 4 + i) for i in range(4)]


def visits(spark, rows):
    return spark.createDataFrame(rows, "k long, d date")


@pytest.fixture
def table(spark, request, tmp_path):
    name = f"v_{abs(hash(request.node.name)) % 10**9}"
    spark.sql(f"CREATE DATABASE {name}")
    t = f"{name}.t"
    empty = visits(spark, []).select("k", "d", F.lit(None).cast("timestamp").alias("batch_time"), F.col("d").alias("dt"))
    versions.create(spark, t, empty.schema, str(tmp_path / "t+1 x"), ["dt"])
    versions.create(spark, t, empty.schema, str(tmp_path / "elsewhere"), ["dt"])  # exists
    versions.overwrite_dates(visits(spark, [(1, D[0]), (2, D[0]), (3, D[1]), (None, D[1]), (5, D[2])]), t, D, F.col("d"))
    yield t
    spark.sql(f"DROP DATABASE {name} CASCADE")


FIRST = [(1, D[0]), (2, D[0]), (3, D[1]), (5, D[2]), (None, D[1])]


def content(spark, t):
    return sorted((tuple(r) for r in spark.table(t).select("k", "dt").collect()), key=lambda r: (r[0] is None, r[0] or 0))


def test_replace_and_delete(spark, table):
    assert content(spark, table) == FIRST and versions.version(spark, table) == 1
    before = spark.table(table)
    assert versions.overwrite_dates(visits(spark, [(9, D[0]), (8, D[2])]), table, [D[0], D[1]], F.col("d")) == 2
    assert content(spark, table) == [(5, D[2]), (9, D[0])]
    assert before.count() == 5  # a query of before reads the files of before
    assert versions.delete_where(spark, table, F.col("k") == 5) == 3
    assert content(spark, table) == [(9, D[0])]
    assert versions.delete_where(spark, table, F.col("k") == 77) == 3
    assert rows_of(versions.read_version(spark, table, 2), "k") == [(5,), (9,)]


def test_a_commit_writes_only_what_it_changes(spark, table, tmp_path):
    places = versions._places(spark, str(tmp_path / "t+1 x"), 1)
    versions.delete_where(spark, table, F.col("k") == 3)
    after = versions._places(spark, str(tmp_path / "t+1 x"), 2)
    assert set(after) == set(places) and {v for v in after if after[v] != places[v]} == {(D[1],)}
    assert content(spark, table) == [(1, D[0]), (2, D[0]), (5, D[2]), (None, D[1])]
    pruned = spark.table(table).where(F.col("dt") == F.lit(D[0]))
    assert "PartitionFilters: [isnotnull(dt" in pruned._jdf.queryExecution().executedPlan().toString() and pruned.count() == 2


@pytest.mark.parametrize("step", ["_write", "_register", "_switch"])
@pytest.mark.parametrize("after", [False, True])
def test_any_step_may_fail(spark, table, monkeypatch, step, after):
    real = getattr(versions, step)

    def broken(*a):
        if after:
            real(*a)
        raise RuntimeError("cut")

    done = step == "_switch" and after
    for change, result in (
        (lambda: versions.overwrite_dates(visits(spark, [(9, D[0])]), table, [D[0], D[1]], F.col("d")), [(5, D[2]), (9, D[0])]),
        (lambda: versions.delete_where(spark, table, F.col("k") == 5), [(9, D[0])]),
    ):
        old = content(spark, table)
        with monkeypatch.context() as m:
            m.setattr(versions, step, broken)
            with pytest.raises(RuntimeError):
                change()
        assert content(spark, table) == (result if done else old)
        change()
        assert content(spark, table) == result


def test_vacuum(spark, table, tmp_path):
    for k in (1, 2, 3):
        versions.delete_where(spark, table, F.col("k") == k)
    left = content(spark, table)
    versions.vacuum(spark, table, keep=1)
    assert content(spark, table) == left == [(5, D[2]), (None, D[1])]
    folders = sorted(p.name[:9] for p in (tmp_path / "t+1 x").iterdir())
    assert folders == ["commit-" + f[7:9] for f in folders[:-1]] + ["manifest-"] and len(folders) == 3
    with pytest.raises(Exception):
        versions.read_version(spark, table, 2)


def test_tables_without_partitions_and_wrong_columns(spark, table, tmp_path):
    flat = table + "flat"
    versions.create(spark, flat, visits(spark, []).schema, str(tmp_path / "flat"))
    versions._commit(spark, flat, visits(spark, [(1, D[0]), (None, D[1])]), set())
    versions.delete_where(spark, flat, F.col("k") > 0)
    assert rows_of(spark.table(flat), "k") == [(None,)]
    with pytest.raises(ValueError, match="extra"):
        versions.overwrite_dates(visits(spark, [(2, D[1])]).withColumn("extra", F.lit(1)), table, [D[1]], F.col("d"))
    with pytest.raises(ValueError, match="not a table with versions"):
        versions.version(spark, f"{table}__v1")
