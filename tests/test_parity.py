"""Every query against its SQL in DuckDB, value for value."""

import pytest
from parity import connect, difference, sides

import __spark_entry__ as entry
from ebbtide.catalog.oracles import ORACLES
from ebbtide.catalog.queries import QUERIES



@pytest.fixture(scope="module")
def db(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, db, small, name):
    assert difference(*sides(spark, db, QUERIES[name], ORACLES[name], small)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    report = entry.entry(spark)
    assert report.count() == 15
    assert report.columns[0] == "feature"
