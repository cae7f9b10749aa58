"""Every registered query next to its SQL, on the smallest tables."""

import oracle_check
import pytest
from conftest import SMALL
from curfew.plans.oracles import ORACLES
from curfew.plans.queries import QUERIES


@pytest.fixture(scope="module")
def connection():
    return oracle_check.tables(SMALL)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


PAIRS = ["CartesianProduct", "BroadcastNestedLoopJoin"]
PYTHON = ["BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"]


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    result = QUERIES[name](spark, SMALL)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in PAIRS + PYTHON if node in plan]
    assert oracle_check.compare(result, connection, ORACLES[name]) is None
