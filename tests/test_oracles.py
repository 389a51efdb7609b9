"""Every registered query against its SQL counterpart at the smallest scale factor."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from testbed import compare
from testbed.oracles import ORACLES
from testbed.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def connection():
    return compare.duckdb_on(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns == ["year", "month_name", "revenue"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare.difference(QUERIES[name](spark, SF_DIR), connection, ORACLES[name]) is None
