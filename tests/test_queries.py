"""Every registered query against its SQL, on the smallest sample tables."""

import pytest

import __spark_entry__ as entry
import check
from rtdw.plans.checks import CHECKS
from rtdw.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return check.duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, sf_dir, name):
    ok, note = check.compare(spark, con, name, sf_dir)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)
    assert QUERIES.keys() <= entry.queries().keys() and CHECKS.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
