"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from catalith import plans
from tests.oracle_compare import compare, connect

FOLDER = os.environ.get("CATALITH_TEST_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = plans.queries(), plans.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert name in SQL
    _, difference = compare(spark, con, FOLDER, QUERIES[name], SQL[name])
    assert difference is None, difference


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
