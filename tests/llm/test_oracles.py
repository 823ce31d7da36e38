"""The queries that SQL can express against DuckDB."""

import pytest

from tesselake.llm import queries

from ..oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_oracle(spark, name):
    assert differences(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name]) is None
