import os
import sys
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from data import captures  # noqa: E402

from footfall.plans import refresh as plans  # noqa: E402
from footfall.plans.refresh import TABLES, Settings, refresh, refresh_changed  # noqa: E402
from footfall.sources.tables import LOAD_TIME  # noqa: E402

DAYS = ["2024-02-29", "2024-03-01", "2024-03-05", "2024-04-29", "2024-04-30", "2024-05-01"]
LOOKBACK = ["new_or_return", "hourly_visitation", "demographics"]


def rows(more=()):
    plain = [(p, t, r, {"day": d}) for d in DAYS for p, t, r in [(1, "10:00:00", 1), (1, "10:30:00", 2), (2, "03:00:00", 1)]]
    return [*plain, *more]


def content(spark, db, tables=TABLES):
    return {t: sorted((tuple(r) for r in spark.table(f"{db}.{t}").drop(LOAD_TIME).collect()), key=repr) for t in tables}


def test_only_what_reads_a_changed_date_is_remade(spark):
    spark.sql("CREATE DATABASE part")
    spark.sql("CREATE DATABASE fresh")
    first = refresh_changed(spark, captures(spark, rows()), "part")
    assert all(first[t] == [date.fromisoformat(d) for d in DAYS] for t in TABLES)
    assert refresh_changed(spark, captures(spark, rows()), "part") == {t: [] for t in TABLES}
    stamps = {t: {r.dt: r[1] for r in spark.table(f"part.{t}").groupBy("dt").agg(F.max(LOAD_TIME)).collect()} for t in TABLES}
    # Visitor 3 comes on the last of February, and returns the next day and two months later.
    new = rows([(3, "11:00:00", 2, {"day": d}) for d in DAYS if d != "2024-04-29"])
    new = [r for r in new if r[0] != 3 or r[3]["day"] == "2024-02-29"]
    done = refresh_changed(spark, captures(spark, new), "part")
    direct, readers = [date(2024, 2, 29)], [date(2024, 2, 29), date(2024, 3, 1), date(2024, 4, 29), date(2024, 4, 30)]
    assert done == {t: readers if t in LOOKBACK else direct for t in TABLES}
    refresh(spark, captures(spark, new), [date.fromisoformat(d) for d in DAYS], "fresh")
    assert content(spark, "part") == content(spark, "fresh")
    after = {t: {r.dt: r[1] for r in spark.table(f"part.{t}").groupBy("dt").agg(F.max(LOAD_TIME)).collect()} for t in TABLES}
    for t in TABLES:
        assert {d for d in stamps[t] if after[t][d] != stamps[t][d]} == set(done[t]) & set(stamps[t])


def test_vanished_dates_and_one_table_alone(spark):
    spark.sql("CREATE DATABASE less")
    df = captures(spark, rows())
    with pytest.raises(ValueError, match="stay_time"):
        refresh_changed(spark, df, "less", only=["visit_detail", "new_or_return"])
    refresh_changed(spark, df, "less", only=["visit_detail", "stay_time"])
    left = df.where("to_date(capture_time) <> '2024-03-05'")
    done = refresh_changed(spark, left, "less", only=["visit_detail", "stay_time"])
    assert done == {t: [date(2024, 3, 5)] for t in ("visit_detail", "stay_time")}
    assert spark.table("less.stay_time").where("dt = '2024-03-05'").count() == 0
    # Only the dates looked at are compared.
    assert refresh_changed(spark, df, "less", only=["visit_detail", "stay_time"], among=[date(2024, 3, 1)])["stay_time"] == []
    assert refresh_changed(spark, df, "less", only=["visit_detail", "stay_time"], among=[date(2024, 3, 5)])["stay_time"] == [date(2024, 3, 5)]


def test_a_call_cut_short_is_made_good(spark, monkeypatch):
    spark.sql("CREATE DATABASE cutoff")
    some = ["visit_detail", "stay_time"]
    refresh_changed(spark, captures(spark, rows()), "cutoff", only=some)
    new = captures(spark, rows([(9, "12:00:00", 1, {"day": DAYS[2]})]))
    with monkeypatch.context() as m:
        real = plans.refresh
        m.setattr(plans, "refresh", lambda *a: (_ for _ in ()).throw(RuntimeError()) if a[5] == ["stay_time"] else real(*a))
        with pytest.raises(RuntimeError):
            refresh_changed(spark, new, "cutoff", only=some)
    assert refresh_changed(spark, new, "cutoff", only=some) == {t: [date.fromisoformat(DAYS[2])] for t in some}
    assert spark.table("cutoff.stay_time").where("profile_id = 9").count() == 1


def test_digests_tell_any_change(spark):
    base = rows()
    sums = lambda r: {tuple(x) for x in plans.date_digests(captures(spark, r)).collect()}
    same = sums(base)
    assert sums(base[:1] + base[2:] + base[1:2]) != same  # capture ids follow the order
    assert sums(base + base[:0]) == same and sums(base[1:]) != same
    for change in ({"age": None}, {"gender": None}, {"age": 31}, {"region_name": ""}):
        assert len(sums([(*base[0][:3], base[0][3] | change), *base[1:]]) ^ same) == 2, change


def test_readers_invert_the_lookback(spark):
    settings = Settings()
    for day in [date(2023, 2, 27) + timedelta(days=i) for i in range(3)] + [date(2024, 2, 29), date(2023, 12, 31)]:
        near = [day + timedelta(days=i) for i in (0, 1, 2, 3, 30, *range(56, 67))]
        want = {x for x in near if day in plans._lookback_dates(spark, [x], settings)}
        found = plans._readers(spark, {day}, settings)
        assert found | {day} == want | {day}
