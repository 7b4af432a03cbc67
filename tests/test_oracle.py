"""Every registered query against its SQL on the given tables."""

import os

import pytest

import __spark_entry__ as entry
from chartloom import catalog
from oracle import compare, connect

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_entry_has_every_query():
    assert set(entry.queries()) >= set(catalog.QUERIES)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    assert compare(catalog.QUERIES[name](spark, SF), con, catalog.ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() == 200
