"""Every registered query against its SQL, as the driver does it; none may loop over pairs."""

import pytest
from compare import differences, oracle_connection

from wordloom.plans.catalog import QUERIES
from wordloom.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    message, rows = differences(result, con, ORACLES[name])
    assert message is None
    assert rows > 0
