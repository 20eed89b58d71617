"""Queries that SQL can express, over a whole small table."""

import pytest

from check import connect, difference
from tillworks.llm.queries import ORACLE_SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert difference(spark, connect(SF_DIR), name, SF_DIR) is None
