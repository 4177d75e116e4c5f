"""Every registered query against its SQL at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from compare import difference

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not present")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_agrees_with_sql(spark, name):
    query = entry.queries()[name]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert query(spark, SF_DIR).collect()
    else:
        assert difference(spark, SF_DIR, query, sql) is None


def test_entry(spark):
    assert entry.entry(spark).collect()
