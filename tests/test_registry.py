"""Every registered query agrees with its SQL on the smallest given tables."""

import os

import pytest

import __spark_entry__ as entry_module
from registry import book
from tests.oracle import compare, connect

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(book.QUERIES) == set(book.ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(book.QUERIES))
def test_query(spark, con, name):
    df = entry_module.queries()[name](spark, SF)
    assert compare(df, con, entry_module.oracle_sql()[name]) == []
