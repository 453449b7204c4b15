"""The registered queries and their SQL; ``oracle_check.py`` compares all of them."""

import os

import pytest
from oracle_check import compare, connect, entry

from sluice.plans import oracles, registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracles.oracle_sql())
    assert set(registered.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None


@needs_data
def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "OrderID" and df.count() > 0
