import compare
import pytest

from plumbline.llm import queries


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_and_sql_agree(spark, name):
    assert compare.difference(spark, "/root/testdata/sf0.001", queries.QUERIES[name], queries.SQL[name]) is None


def test_one_query_an_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
