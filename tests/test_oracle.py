"""Every query of the registry on the smallest tables, beside its SQL where it has one."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from tidemark.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
ENTRY_QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, con, name):
    assert difference(spark, con, SF, name, ENTRY_QUERIES[name], ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "day"
