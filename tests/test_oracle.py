"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from catalog import all_oracles, all_queries
from check import compare, connect

pytestmark = pytest.mark.slow
SF = "/root/testdata/sf0.001"
QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    message, _, _, ok = compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name))
    assert ok is not False, message


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
