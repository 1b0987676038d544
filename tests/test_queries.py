"""Every registered query against its check SQL, and the driver contract."""

import pytest

import __spark_entry__ as contract
from check import connect, difference
from tickloom.plans import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


# Plan nodes that would not scale: products, nested loops, Python workers.
UNWANTED = ["CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_its_check(spark, folder, con, name):
    df = QUERIES[name](spark, folder)
    ours = df.toPandas()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    if name in CHECKS:
        assert difference(ours, con.execute(CHECKS[name]).df()) is None
    else:
        assert len(ours) > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(CHECKS) and set(QUERIES) <= set(contract.queries())
    result = contract.entry(spark)
    assert {"prediction", "close", "rmse"} <= set(result.columns)
    assert result.count() > 0
