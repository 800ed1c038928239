"""Every registered query against its DuckDB twin."""

import os

import pytest
from check_oracle import compare, duck

import __spark_entry__ as registered
from wayfare.workload.oracle import ORACLE
from wayfare.workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE) <= set(registered.queries())


def test_entry(spark):
    result = registered.entry(spark)
    assert result.columns[:2] == ["c_mktsegment", "total_trips"]
    assert result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, name, FOLDER) == ""
