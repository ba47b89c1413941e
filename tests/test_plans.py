"""Plan shape guards: every registered query stays JVM-side, and the cleaning
stage stays one narrow stage (no data-sized shuffle)."""

import os

import pytest

from yearweave.plans.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow", "FlatMapGroupsInArrow", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_evaluation(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not [n for n in PYTHON_NODES if n in plan]


def test_cleaning_stage_is_narrow(spark):
    plan = plan_of(QUERIES["clean_death_records"](spark, SF))
    assert "Exchange hashpartitioning" not in plan
    assert "SortMergeJoin" not in plan
