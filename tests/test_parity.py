"""Every registered query against its SQL, and the shape of the driver contract."""

import os

import pytest

import __spark_entry__ as contract
from tablehaul.registry import all_queries
from tests.parity import DATA, connect, difference

SF = f"{DATA}/{os.environ.get('TABLEHAUL_TEST_SF', 'sf0.001')}"
QUERIES = all_queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    q = QUERIES[key]
    if q.sql:
        assert difference(q, spark, con, SF) is None
    else:
        assert q(spark, SF).count() > 0


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["p_brand", "p_type", "net_revenue", "qty_sold"]
