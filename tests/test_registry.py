"""Every registered query against its SQL, and what its plan must not contain."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from retailmill.plans.oracle import ORACLE as SQL
from retailmill.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("EvalPython", "InPandas", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert node not in plan
    assert difference(df, con, SQL[name]) is None
