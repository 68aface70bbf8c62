"""Every registered query with SQL gives DuckDB's result; the others run and return rows."""

import pytest
from compare import both, database
from conftest import SMALL

from tidewater.plans import registry


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, con, name):
    ours, theirs = both(registry.QUERIES[name](spark, SMALL), con, registry.SQL[name])
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SMALL).count() > 0
