"""Corpus queries that SQL can express, against it, and the names of all."""

import oracle
import pytest

from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    con = oracle.connect()
    assert oracle.compare(queries.QUERIES[name](spark, oracle.FOLDER), con, queries.ORACLE[name]) is None


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES) == list(range(1, 14))
