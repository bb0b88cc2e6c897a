"""Every registered query against its SQL on the smallest tables, and what its plan must not contain."""

from __future__ import annotations

import pytest
from oracle import connect, differences

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(contract.queries()))
def test_query_equals_sql(spark, con, name):
    df = contract.queries()[name](spark, SF)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_flagship(spark):
    assert contract.entry(spark).columns == ["branch", "readings"]


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(contract.queries())
