"""Every query equals its SQL twin, row for row, on whole tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tablework.plans import all_queries, all_sql
from tests.oracle import connect, rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_table_query_has_sql():
    assert set(all_queries()) == set(all_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_equals_sql(spark, duck, name):
    expected = rows(duck.execute(oracle_sql()[name]).df())
    actual = rows(queries()[name](spark, SF_DIR).toPandas())
    assert actual[0] == expected[0]
    assert len(actual[1]) == len(expected[1])
    assert actual[1] == expected[1]
