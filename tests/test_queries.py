"""Every registered query against its SQL on the given tables."""

import pytest

import __spark_entry__ as entry
from check import compare, duck
from curbflow import plans

NAMES = list(plans.queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    assert compare(con, df, entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracle_sql())
    assert set(plans.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
