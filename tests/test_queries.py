"""Every registered query against its SQL form, and what its plan must not hold."""

import pytest

import __spark_entry__ as entry
from ledgerline.queries import QUERIES
from compare import compare, connect

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con(small_dir):
    return connect(small_dir)


@pytest.mark.parametrize("key", KEYS)
def test_query(spark, small_dir, con, key):
    df = entry.queries()[key](spark, small_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "CartesianProduct",
                 "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert compare(df, con, entry.oracle_sql()[key]) == []


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert sum(r["rows"] for r in rows) == 1500


def test_names():
    assert set(KEYS) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
