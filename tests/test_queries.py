"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as entry
from checks import QUERIES, SQL
from checks.compare import differences, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    problems = [p for p in differences(df, con, SQL[name]) if "note" not in p]
    assert not problems
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert "currentrow$(), unboundedfollowing" not in plan  # quadratic in the partition


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["symbol", "date", "close"]
    assert df.where("close IS NULL").isEmpty()
    assert df.count() == 15 * 30


def test_all_have_sql():
    assert set(SQL) == set(NAMES)
    assert set(NAMES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())
