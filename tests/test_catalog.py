"""Every registered query against its SQL, on the smallest test tables."""

from pathlib import Path

import pytest
from compare import compare, connect

from __spark_entry__ import SMOKE_DIR, entry, oracle_sql, queries
from oracle.queries import SQL
from tierwright.plans.catalog import QUERIES

pytestmark = pytest.mark.skipif(not Path(SMOKE_DIR).is_dir(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SMOKE_DIR)


def test_each_query_has_sql():
    assert QUERIES.keys() == SQL.keys()
    assert QUERIES.keys() <= queries().keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SMOKE_DIR) is None


def test_entry(spark):
    assert entry(spark).count() > 0
