"""Every registered query against its SQL twin, and what its plan must not hold."""

import io
from contextlib import redirect_stdout

import oracle
import pytest

import __spark_entry__ as entry_points

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()
# Corpus operators may run Python in their tasks and have tests of their own.
CORPUS = ("op", "pipeline")
BATCH = sorted(name for name in QUERIES if not name.startswith(("stream_", *CORPUS)))


@pytest.fixture(scope="module")
def con():
    return oracle.connect()


@pytest.mark.parametrize("name", sorted(name for name in SQL if not name.startswith(CORPUS)))
def test_equals_sql(spark, con, name):
    assert oracle.compare(QUERIES[name](spark, oracle.FOLDER), con, SQL[name]) is None


def test_every_twin_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", BATCH)
def test_plan(spark, name):
    frame = QUERIES[name](spark, oracle.FOLDER)
    text = io.StringIO()
    with redirect_stdout(text):
        frame.explain()
    plan = text.getvalue()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    assert "ArrowEvalPython" not in plan


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.columns == ["_id", "document"]
    assert frame.count() > 0


def test_find_sort_order(spark, con):
    rows = QUERIES["find_sort"](spark, oracle.FOLDER).collect()
    assert [tuple(row) for row in rows] == con.execute(SQL["find_sort"]).fetchall()


def test_every_library_query_has_a_twin():
    assert {name for name in set(QUERIES) - set(SQL) if not name.startswith(("op", "pipeline"))} == set()
