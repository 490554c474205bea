"""Physical-plan checks over every registered query: no Python execution (UDFs), no
cross/nested-loop joins, and scans read only the columns a query needs."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from careflow.plans import catalog

from conftest import SF0001

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "PythonUDF", "CartesianProduct", "BroadcastNestedLoopJoin")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_and_no_cross_join(spark, name):
    df = E.queries()[name](spark, SF0001)
    plan = _plan(df)
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, (name, bad)


def test_column_pruning_reaches_the_scan(spark):
    df = E.queries()["q08_wait_histogram"](spark, SF0001)
    plan = _plan(df)
    lineitem_scans = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert lineitem_scans
    for line in lineitem_scans:
        # the histogram needs the join keys and the wait, not prices (the visit id) or
        # the return flag (the segment key)
        assert "l_extendedprice" not in line and "l_returnflag" not in line
