"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from checks import compare, queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", list(registered.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in entry.oracle_sql()
    assert compare.compare(spark, con, name, SF).startswith("equal")


def test_entry(spark):
    assert entry.entry(spark).count() > 0
