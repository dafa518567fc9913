import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import rows_of  # noqa: E402

from footfall.sources import ledger  # noqa: E402


@pytest.fixture
def db(spark, request):
    name = f"l_{abs(hash(request.node.name)) % 10**9}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def put(path, rows, mode="w"):
    path.parent.mkdir(exist_ok=True)
    with path.open(mode) as f:
        f.write("" if mode == "a" else "k,v x\n")
        f.writelines(f"{k},{v}\n" for k, v in rows)


def content(spark, table):
    return rows_of(spark.table(table), "k", "v_x")


def test_new_and_grown_files(spark, db, tmp_path):
    folder, t = str(tmp_path), f"{db}.sales_2024"
    put(tmp_path / "sales 2024.csv" / "a+b %.csv", [(1, "a"), (2, "b")])
    put(tmp_path / "other.csv", [(7, "z")])
    assert ledger.load_new(spark, folder, db) == {f"{db}.other": 1, t: 2}
    assert ledger.load_new(spark, folder, db) == {f"{db}.other": 0, t: 0}
    put(tmp_path / "sales 2024.csv" / "a+b %.csv", [(3, "c"), (3, "c")], "a")
    put(tmp_path / "sales 2024.csv" / "new.csv", [(4, "d")])
    (tmp_path / "sales 2024.csv" / "none.csv").write_text("")
    assert ledger.load_new(spark, folder, db)[t] == 3
    assert content(spark, t) == [(1, "a"), (2, "b"), (3, "c"), (3, "c"), (4, "d")]
    assert ledger.load_new(spark, folder, db)[t] == 0
    noted = spark.table(f"{db}.{ledger.LEDGER}").where("state = 'done' AND first_row > 0").collect()
    assert [(r.first_row, r.rows) for r in noted] == [(2, 2)]


def test_rows_are_numbered_over_many_splits(spark, db, tmp_path):
    rows = [(i, f"v{i}") for i in range(5000)]
    put(tmp_path / "big.csv", rows[:3210])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert ledger.load_new(spark, str(tmp_path), db) == {f"{db}.big": 3210}
        put(tmp_path / "big.csv", rows[3210:], "a")
        put(tmp_path / "small.csv", rows[:1])
        assert ledger.load_new(spark, str(tmp_path), db) == {f"{db}.big": 1790, f"{db}.small": 1}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert content(spark, f"{db}.big") == sorted(rows)


@pytest.mark.parametrize("step", ["write", "overwrite_partitions", "finish"])
def test_a_load_cut_at_any_step(spark, db, tmp_path, monkeypatch, step):
    t = f"{db}.a"
    put(tmp_path / "a.csv", [(1, "a")])
    ledger.load_new(spark, str(tmp_path), db)
    put(tmp_path / "a.csv", [(2, "b")], "a")

    def broken(*_, **__):
        raise RuntimeError("cut")

    with monkeypatch.context() as m:
        m.setattr(ledger, step, broken)
        with pytest.raises(RuntimeError):
            ledger.load_new(spark, str(tmp_path), db)
    assert ledger.load_new(spark, str(tmp_path), db) == {t: 1}
    assert content(spark, t) == [(1, "a"), (2, "b")]
    assert ledger.load_new(spark, str(tmp_path), db) == {t: 0}


def test_files_that_were_rewritten_are_refused(spark, db, tmp_path):
    put(tmp_path / "a.csv", [(1, "a"), (2, "b")])
    ledger.load_new(spark, str(tmp_path), db)
    put(tmp_path / "a.csv", [(1, "a")])
    with pytest.raises(ValueError, match="smaller"):
        ledger.load_new(spark, str(tmp_path), db)
    put(tmp_path / "a.csv", [(1, "a" * 90)])
    with pytest.raises(ValueError, match="fewer rows"):
        ledger.load_new(spark, str(tmp_path), db)
    assert content(spark, f"{db}.a") == [(1, "a"), (2, "b")]
