"""Every registered query against its SQL twin, on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_module
from compare import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, message = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert len(entry_module.entry(spark).columns) == 14
