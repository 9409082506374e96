"""Every query of the fleet part against its SQL on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import compare, connect
from checks.oracle import statements
from checks.queries import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry(), statements()


@pytest.fixture(scope="module")
def connection():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(queries()) and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert compare(spark, connection, SF, QUERIES[name], SQL[name]) is None


def test_entry_has_the_known_size(spark):
    assert entry(spark).count() == 2
