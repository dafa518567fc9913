"""Every registered query against its SQL twin."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as contract  # noqa: E402
from compare import assert_same, connect  # noqa: E402

from footfall.plans.catalogue import QUERIES  # noqa: E402
from footfall.plans.oracle import CAPTURES, ORACLE  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_data_reaches_the_rules(con):
    """Rows without which a wrong rule would give the same result as the right one."""
    count = lambda sql: con.execute(sql).fetchall()[0][0]
    view = f"WITH {CAPTURES} "
    assert count(view + "SELECT count(*) FROM (SELECT profile_id, capture_time FROM captures GROUP BY ALL HAVING count(*) > 1)") > 20
    several = "SELECT profile_id FROM captures GROUP BY ALL HAVING count(DISTINCT (member_tier, age, gender)) > 1"
    assert count(f"{view} SELECT count(*) FROM ({several})") > 20
    for column in ("age", "member_tier", "gender"):
        assert count(f"{view} SELECT count(*) FROM captures WHERE {column} IS NULL") > 20
    assert count(f"SELECT count(*) FROM ({ORACLE['stay_time']}) WHERE stay_time % 1 <> 0") > 20
    assert count(f"SELECT sum(is_return_zone) FROM ({ORACLE['new_or_return_long']})") > 100
    assert count(f"SELECT sum(return_zone_num) FROM ({ORACLE['demographics_long']})") > 100


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "date" and df.count() > 0


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert not [c for c in df.columns if "." in c]
    assert assert_same(df, con, ORACLE[name].strip()) > 0
