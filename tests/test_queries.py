"""Every registered query against its SQL statement on an independent engine."""

import pytest

import __spark_entry__ as entry
from oracles.catalog import statements
from tests.compare import connect, difference
from tests.conftest import SF
from trailsight.plans.catalog import QUERIES

STATEMENTS = statements()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(entry.queries()) and set(STATEMENTS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF)
    assert difference(frame, con, STATEMENTS[name]) is None
    if not name.startswith("stream_"):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan
        assert "NestedLoopJoin" not in plan
        assert "PythonUDF" not in plan and "ArrowEval" not in plan


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and all(r["rank"] >= 1 for r in rows)
