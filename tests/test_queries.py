"""Every registered query against its SQL, on the smallest tables."""

import pytest
from compare import difference, oracle_connection

from __spark_entry__ import entry, oracle_sql, queries
from chargelake.plans.oracles import ORACLES
from chargelake.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, connection, name):
    assert difference(connection, QUERIES[name](spark, SF_DIR), ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
