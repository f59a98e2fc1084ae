"""Every registered query against its check SQL, over whole tables."""

import os

import pytest

from rollcall.queries import CHECKS, QUERIES
from tests.compare import compare, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], CHECKS[name], SF_DIR) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    import __spark_entry__ as driver

    df = driver.entry(spark)
    assert df.columns[0] == "key" and df.count() > 0
    assert QUERIES.keys() <= driver.queries().keys()
    assert CHECKS.keys() <= driver.oracle_sql().keys() <= driver.queries().keys()
