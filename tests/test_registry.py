"""Every registered query against its check SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, CHECKS = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no given tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_check_has_a_query():
    assert set(CHECKS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in CHECKS:
        compare(spark, con, QUERIES[name], CHECKS[name], SF_DIR)
    else:
        assert QUERIES[name](spark, SF_DIR).count() >= 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
