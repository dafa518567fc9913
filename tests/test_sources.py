import os
import sys
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import at, captures, rows_of  # noqa: E402

from footfall.sources import csv_files, tables  # noqa: E402
from footfall.sources.captures import conform, in_dates, on_dates, read_captures  # noqa: E402

D1, D2, D3 = date(2024, 3, 5), date(2024, 3, 6), date(2024, 3, 7)


def visits(spark, rows):
    return spark.createDataFrame(rows, "k long, d date")


@pytest.fixture
def db(spark, request):
    name = f"t_{abs(hash(request.node.name)) % 10**9}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


# Captures -------------------------------------------------------------------


def test_read_captures_casts_and_prunes(spark, tmp_path):
    path = str(tmp_path / "captures")
    captures(spark, [(1, "10:00:00", 1), (1, "10:00:00", 1, {"day": "2024-03-06"})]).withColumn(
        "capture_time", F.col("capture_time") + F.expr("INTERVAL '0.25' SECOND")
    ).withColumn("profile_id", F.col("profile_id").cast("string")).write.parquet(path)
    df = read_captures(spark, path, [D2])
    assert rows_of(df, "profile_id", "capture_time") == [(1, at("10:00:00", "2024-03-06"))]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(capture_time,2024-03-06T00:00)" in plan


def test_conform_names_what_is_missing(spark):
    with pytest.raises(ValueError, match="camera_id"):
        conform(captures(spark, []).drop("camera_id"))


def test_neighbouring_dates_are_one_range(spark):
    text = str(in_dates(F.col("t"), [D1, D2, D3]))
    assert text.count(">=") == 1
    df = spark.createDataFrame([(datetime(2024, 3, d, 23, 59, 59),) for d in range(3, 9)], "t timestamp_ntz")
    assert [r.t.day for r in on_dates(df, "t", [D3, D1]).collect()] == [5, 7]
    assert on_dates(df, "t", []).count() == 0


# Tables ---------------------------------------------------------------------


def test_overwrite_replaces_only_its_dates(spark, db):
    t = f"{db}.v"
    tables.overwrite_dates(visits(spark, [(1, D1), (2, D2), (3, D3)]), t, [D1, D2, D3], F.col("d"))
    tables.overwrite_dates(visits(spark, [(9, D1), (8, D3)]), t, [D1, D2], F.col("d"))
    # D1 replaced, D2 has no rows any more, D3 untouched although rows came for it.
    assert rows_of(spark.table(t), "k", "dt") == [(3, D3), (9, D1)]
    assert spark.table(t).where("batch_time is null").count() == 0
    before = rows_of(spark.table(t), "k", "dt")
    tables.overwrite_dates(visits(spark, [(9, D1)]), t, [D1], F.col("d"))
    assert rows_of(spark.table(t), "k", "dt") == before


def test_overwrite_checks_before_it_writes(spark, db):
    t = f"{db}.v"
    tables.overwrite_dates(visits(spark, [(1, D1)]), t, [D1], F.col("d"))
    with pytest.raises(ValueError, match="extra"):
        tables.overwrite_dates(visits(spark, [(2, D1)]).withColumn("extra", F.lit(1)), t, [D1], F.col("d"))
    tables.create_table(spark, f"{db}.flat", visits(spark, []).schema)
    with pytest.raises(ValueError, match="partitioned"):
        tables.overwrite_dates(visits(spark, [(2, D1)]), f"{db}.flat", [D1], F.col("d"))
    assert rows_of(spark.table(t), "k") == [(1,)]


def test_overwrite_matches_columns_by_name(spark, db):
    t = f"{db}.v"
    tables.overwrite_dates(visits(spark, [(1, D1)]), t, [D1], F.col("d"))
    tables.overwrite_dates(visits(spark, [(5, D1)]).select("d", "k"), t, [D1], F.col("d"))
    assert rows_of(spark.table(t), "k", "d") == [(5, D1)]


def test_append_query_rows_copy_truncate(spark, db):
    t = f"{db}.stats"
    schema = spark.createDataFrame([], "date date, user_id long, page_views int, clicks int").schema
    tables.create_table(spark, t, schema)
    tables.create_table(spark, t, schema)
    tables.append_rows(spark, t, [{"date": D1, "user_id": 31, "page_views": 6, "clicks": 2}, {"user_id": 7}])
    assert rows_of(spark.table(t).where("user_id = 7"), "date", "clicks") == [(None, None)]
    tables.append_query(
        spark, f"SELECT clicks, user_id + 1 AS user_id FROM {t} WHERE date = :day", t, {"day": D1}
    )
    assert rows_of(spark.table(t).where("user_id = 32"), "page_views", "clicks") == [(None, 2)]
    with pytest.raises(ValueError):
        tables.append_rows(spark, t, [{"nope": 1}])
    tables.create_table(spark, f"{db}.ids", spark.createDataFrame([], "user_id long").schema)
    tables.copy_columns(spark, t, f"{db}.ids", ["user_id"])
    assert rows_of(spark.table(f"{db}.ids"), "user_id") == [(7,), (31,), (32,)]
    tables.truncate(spark, t)
    assert spark.table(t).count() == 0


def test_delete_where(spark, db):
    t = f"{db}.v"
    tables.overwrite_dates(visits(spark, [(1, D1), (2, D1), (None, D1), (2, D2), (3, D3)]), t, [D1, D2, D3], F.col("d"))
    tables.delete_where(spark, t, F.col("k") == 2)
    left = sorted((r.k or 0, r.dt) for r in spark.table(t).collect())
    assert left == [(0, D1), (1, D1), (3, D3)]
    tables.delete_where(spark, t, F.col("k") == 99)
    assert spark.table(t).count() == 3
    flat = f"{db}.flat"
    tables.create_table(spark, flat, visits(spark, []).schema)
    tables.append(visits(spark, [(1, D1), (None, D2)]), flat)
    tables.delete_where(spark, flat, F.col("k") > 0)
    assert spark.table(flat).count() == 1


# CSV ------------------------------------------------------------------------

CSV = """user id,is-new,a.b,amount,note,seen
1,true,5,1.5,x,2024-01-02 03:04:05
2,false,,2.25,,2024-01-02 03:04:06
"""


def test_csv_types_names_and_nulls(spark, tmp_path):
    (tmp_path / "people list.csv").write_text(CSV)
    df = csv_files.read_csv(spark, str(tmp_path / "people list.csv"))
    assert dict(df.dtypes) == {
        "user_id": "bigint", "is_new": "int", "a_b": "bigint", "amount": "double", "note": "string",
        "seen": "timestamp_ntz",
    }
    assert [tuple(r) for r in df.orderBy("user_id").collect()] == [
        (1, 1, 5, 1.5, "x", datetime(2024, 1, 2, 3, 4, 5)),
        (2, 0, None, 2.25, "", datetime(2024, 1, 2, 3, 4, 6)),
    ]
    text = csv_files.read_csv(spark, str(tmp_path / "people list.csv"), stringify_floats=True)
    assert dict(text.dtypes)["amount"] == "string"


def test_csv_folder_becomes_tables(spark, db, tmp_path):
    (tmp_path / "people.csv").write_text(CSV)
    (tmp_path / "zone sales.csv").write_text("hour,zone,sales\n1,a,2\n")
    (tmp_path / "readme.txt").write_text("not a table")
    loaded = csv_files.load_csv_folder(spark, str(tmp_path), db, skip=["*.txt"])
    assert loaded == [f"{db}.people", f"{db}.zone_sales"]
    assert spark.table(f"{db}.people").count() == 2
    csv_files.load_csv_folder(spark, str(tmp_path), db, skip=["*.txt"])
    assert spark.table(f"{db}.people").count() == 4


def test_clashing_names_are_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a b,a-b\n1,2\n")
    with pytest.raises(ValueError, match="a_b"):
        csv_files.read_csv(spark, str(tmp_path / "x.csv"))


def test_bad_rows_fail_or_are_kept(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,2\n3,4,5\n")
    path = str(tmp_path / "x.csv")
    with pytest.raises(Exception, match="MALFORMED|[Mm]alformed"):
        csv_files.read_csv(spark, path).collect()
    kept = csv_files.read_csv(spark, path, keep_bad_rows=True)
    assert sorted(r._corrupt_record or "" for r in kept.collect()) == ["", "3,4,5"]


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,b\n1,"two\nlines"\n')
    rows = csv_files.read_csv(spark, str(tmp_path / "x.csv"), multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines")]


def test_every_file_of_a_folder_is_loaded_or_refused(spark, db, tmp_path):
    (tmp_path / "UPPER.CSV").write_text("a,b\n1,x\n")
    (tmp_path / "plain.txt").write_text("a,b\n2,y\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="sub"):
        csv_files.load_csv_folder(spark, str(tmp_path), db)
    loaded = csv_files.load_csv_folder(spark, str(tmp_path), db, skip=["sub"])
    assert loaded == [f"{db}.UPPER", f"{db}.plain_txt"]
    assert rows_of(spark.table(f"{db}.UPPER"), "a", "b") == [(1, "x")]


def test_names_that_clash_are_refused_before_loading(spark, db, tmp_path):
    (tmp_path / "a b.csv").write_text("a\n1\n")
    (tmp_path / "a-B.csv").write_text("a\n2\n")
    with pytest.raises(ValueError, match="one table name"):
        csv_files.load_csv_folder(spark, str(tmp_path), db)
    assert not spark.catalog.tableExists(f"{db}.a_b")


def test_parts_are_matched_by_header(spark, tmp_path):
    parts = tmp_path / "parts.csv"
    parts.mkdir()
    (parts / "1.csv").write_text("a,b\n1,x\n")
    (parts / "2.csv").write_text("b,a\ny,2.5\n")
    assert rows_of(csv_files.read_csv(spark, str(parts)), "a", "b") == [(1.0, "x"), (2.5, "y")]
    (parts / "3.csv").write_text("a,c\n1,x\n")
    with pytest.raises(ValueError, match="columns"):
        csv_files.read_csv(spark, str(parts))


def test_headers_and_types_take_as_many_jobs_for_any_number_of_parts(spark, tmp_path):
    def jobs(parts):
        folder = tmp_path / f"{parts}.csv"
        folder.mkdir()
        for i in range(parts):
            order = "a b,when,x" if i % 2 else "x,a b,when"
            row = f"{i},2024-01-0{i % 9 + 1},{i}.5" if i % 2 else f"{i},{i},2024-01-01 10:00:00"
            (folder / f"{i} %.csv").write_text(f"{order}\n{row}\n\n")
        spark.sparkContext.setJobGroup(f"read {parts}", "")
        df = csv_files.read_csv(spark, str(folder))
        ran = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"read {parts}"))
        assert dict(df.dtypes) == {"x": "double", "a_b": "bigint", "when": "timestamp_ntz"} and df.count() == parts
        return ran

    assert jobs(3) == jobs(24) <= 6


@pytest.mark.parametrize(
    "cells, kind, value",
    [
        (["1", "", "-7"], "bigint", 1), (["1", "99999999999999999999"], "double", 1.0), (["1", "1e3", "NaN"], "double", 1.0),
        (["2024-01-02"], "date", date(2024, 1, 2)), (["2024-13-02"], "string", "2024-13-02"), (["2024"], "bigint", 2024),
        (["2024-01-02", "2024-01-02T03:04:05Z"], "timestamp_ntz", datetime(2024, 1, 2)), (["1", "2024-01-02"], "string", "1"),
        (["true", "False"], "int", 1), (["true", "1"], "string", "true"), (["", ""], "string", ""), (["c"], "string", "c"), (["+5", "5."], "double", 5.0),
    ],
)
def test_types_of_cells(spark, tmp_path, cells, kind, value):
    (tmp_path / "x.csv").write_text("k,c\n" + "".join(f"{i},{c}\n" for i, c in enumerate(cells)))
    df = csv_files.read_csv(spark, str(tmp_path / "x.csv"))
    assert dict(df.dtypes) == {"k": "bigint", "c": kind}
    assert df.where("k = 0").first().c == value


def test_columns_without_a_name_and_headers_in_the_midst(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",v\n0,1\n,v\n")
    assert rows_of(csv_files.read_csv(spark, str(tmp_path / "x.csv")), "_c0", "v") == [("", "v"), ("0", "1")]


def test_scratch_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from footfall.sources import scratch

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, folder = "yarn", None

        def getCheckpointDir(self):
            return self.folder

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_path(Session, "x")
    monkeypatch.setattr(Context, "folder", "hdfs://shared/checkpoints")
    assert scratch.scratch_path(Session, "x").startswith("hdfs://shared/checkpoints/x-")
    monkeypatch.setattr(Context, "folder", None)
    monkeypatch.setattr(Context, "master", "local[2]")
    assert scratch.scratch_path(Session, "x").startswith("/")


def test_scratch_is_removed(spark, tmp_path):
    from footfall.sources import scratch

    with scratch.cleared():
        df = scratch.stored(spark.range(3), "kept")
        path = df.inputFiles()[0].removeprefix("file://")
        assert df.count() == 3 and os.path.exists(path)
    assert not os.path.exists(path)
