"""Registered corpus queries against their SQL."""

import pytest

from tools.check_oracle import compare, duck
from tradewind.llm.queries import SQL

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    ok, text = compare(spark, duck(SF_DIR), name, SF_DIR)
    assert ok, text
