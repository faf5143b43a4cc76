"""The library's own queries against their SQL counterparts on the smallest data; tests/llm has the others."""

import pytest

import __spark_entry__ as entry
from sidebyside import compare
from workload.queries import QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, small, name):
    outcome = compare(entry.queries()[name](spark, small), duck, entry.oracle_sql()[name])
    assert outcome.startswith("OK"), outcome


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
