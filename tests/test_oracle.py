"""Every registered query against its SQL on the smallest tables, and no pair joins."""

import pytest

from checks import QUERIES_AND_ORACLES
from checks.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = QUERIES_AND_ORACLES


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    rows = df.toPandas()
    assert len(rows) > 0
    assert difference(rows, db.execute(ORACLES[name]).df()) is None
