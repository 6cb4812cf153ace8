"""Every registered query against its SQL oracle on the smallest data set."""

from __future__ import annotations

import os

import pytest

from checks import compare, oracles, registry

FOLDER = os.environ.get("AQUIFOLD_TEST_DATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test data not present")

NO_SQL = {"gbt_forecast", "horizon_sweep", "feature_importance"}


def test_every_deterministic_query_has_an_oracle():
    assert set(registry.queries()) - set(oracles.oracle_sql()) == NO_SQL
    assert set(oracles.oracle_sql()) <= set(registry.queries())


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query(spark, connection, name):
    problem = compare.compare(spark, connection, FOLDER, name)
    if problem == "no rows" and name in NO_SQL:
        pytest.skip("the smallest data set has no test rows")
    assert problem == ""
