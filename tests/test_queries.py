"""Every registered query next to its SQL, and rules about the registry itself."""

import pytest

import __spark_entry__ as entry
from tidemark.queries import QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
# the operators that run Python functions on Arrow batches
PYTHON = ("udf", "src04", "win03")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if not name.startswith(PYTHON):
        assert not [op for op in ("EvalPython", "InPandas", "InArrow", "PythonUDF") if op in plan]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert compare(df, con, sql) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "_deleted"]
    assert df.count() == 1800


def test_sql_without_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
