"""The registered queries of the operators: names, and those with SQL against it."""

import pytest
from check import compare, duck

import __spark_entry__ as entry
from curbflow import llm


def test_names():
    names = list(llm.queries())
    assert [int(n[2:].split("_")[0]) for n in names] != [] and len(names) == 13
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry.queries())
    assert set(llm.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, name):
    assert compare(duck(sf_dir), llm.queries()[name](spark, sf_dir), llm.oracle_sql()[name]) is None
