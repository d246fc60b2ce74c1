"""Every registered query against its SQL, on the smallest data."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import checker, compare
from linkloom.catalog import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"



@pytest.fixture(scope="module")
def connection():
    return checker(DATA)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    rows, _, plan = compare(spark, name, QUERIES[name], ORACLES.get(name), DATA, connection)
    assert rows > 0
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert operator not in plan


def test_all_have_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys() <= queries().keys()


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 100 and rows == sorted(rows, key=lambda r: (-r["count"], r["page_title"]))
