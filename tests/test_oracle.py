"""Every catalogue query against its SQL twin on the smallest generated tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from foulee.testbed import catalogue, oracle
from tools.check_oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="generated tables not present")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(catalogue.QUERIES) == set(oracle.oracle_sql())
    assert set(catalogue.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name) is None


def test_entry(spark):
    benefits = entry.entry(spark)
    clean = entry.queries()["clean_employees"](spark, SF_DIR)
    assert benefits.count() == clean.count() > 0
