"""Every query against its SQL twin."""

from __future__ import annotations

import compare
import driver_queries
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(driver_queries.QUERIES) == set(driver_queries.SQL)


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_same_result_as_sql(spark, connection, name):
    ours = queries()[name](spark, FOLDER).toPandas()
    theirs = connection.sql(oracle_sql()[name]).df()
    assert compare.difference(ours, theirs) == ""


def test_entry(spark):
    assert entry(spark).count() == 25
