"""Every registered query against its SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from harkline.catalog.oracle import ORACLE
from harkline.catalog.queries import QUERIES
from tests.compare import compare, duck
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.oracle_sql()))
def test_query(spark, con, name):
    assert compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SMALL) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
