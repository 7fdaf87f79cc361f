"""Every registered query against its SQL counterpart."""

import pytest

import __spark_entry__ as entry
from chromasea.queries import QUERIES
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# Queries of the optional subpackage have tests of their own.
OWN = [n for n in entry.queries() if n in QUERIES]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    status, note = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert status in ("ok", "rows-only"), f"{status}: {note}"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(entry.oracle_sql()) >= set(OWN)
