"""Queries of this subpackage that SQL can express: their rows are those of the SQL."""

import pytest

from presswork.llm.queries import oracle_sql, queries
from tests.oracle import compare, connection


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_rows_are_those_of_the_sql(spark, sf, name):
    sf = sf.replace("0.001", "0.01")
    compare(spark, connection(sf), name, queries()[name], oracle_sql()[name], sf)
