"""Every registered query against its SQL."""

import check_oracle
import pytest

import __spark_entry__ as entry
from drivesync.plans import oracle
from drivesync.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return check_oracle.duck(sf)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.SQL)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    assert check_oracle.compare(spark, con, sf, name, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["collection", "files", "bytes", "chunks"] and result.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_no_cross_join_and_no_row_python(spark, sf, name):
    # What q03, q26, q29 and q36 run while they are built is not part of this plan.
    plan = entry.queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan
