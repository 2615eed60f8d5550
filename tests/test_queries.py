"""Every registered query against its SQL on the smallest tables."""

import pytest

from flowbook.queries import ORACLES, QUERIES

from .oracle import compare, connection

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert name in ORACLES, "every query has a SQL counterpart"
    ok, message, _, _ = compare(spark, con, name, SF, QUERIES[name], ORACLES[name])
    assert ok, message
