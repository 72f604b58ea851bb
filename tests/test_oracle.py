"""Every registered batch query against its SQL on the smallest sample tables."""

import os

import pytest

from __spark_entry__ import entry
from catalog.oracle import statements
from catalog.queries import QUERIES
from tools.check_oracle import compare, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="sample tables are not here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(statements())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    ok, text = compare(spark, con, name, SF_DIR)
    assert ok, text


def test_entry(spark):
    assert entry(spark).columns == ["spu_name", "order_amount", "order_ct"]
