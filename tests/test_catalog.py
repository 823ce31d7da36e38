"""Every query of the catalog against DuckDB."""

import pytest

from tesselake.plans import file_catalog  # noqa: F401, registers its queries
from tesselake.plans.catalog import ORACLES, QUERIES

from .oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None
