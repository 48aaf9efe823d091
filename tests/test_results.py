"""Every registered query with SQL agrees with it on the test tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as contract  # noqa: E402
from check_results import connect, difference  # noqa: E402

FOLDER = "/root/testdata/sf0.01"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, db, name):
    found = contract.queries()[name](spark, FOLDER).toPandas()
    assert difference(found, db.execute(SQL[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 20
