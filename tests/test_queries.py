"""Every registered query against DuckDB on the given tables, and what its plan must not hold."""

import os

import oracle
import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")

# The optional training-data queries have tests of their own.
QUERIES = {key: f for key, f in entry_point.queries().items() if key not in entry_point.LLM_QUERIES}
ORACLES = {key: sql for key, sql in entry_point.oracle_sql().items() if key in QUERIES}


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key, monkeypatch):
    written = []
    for kind in ("parquet", "csv", "text"):

        def noted(self, *args, write=getattr(DataFrameWriter, kind), **kwargs):
            # The frame of every write on the way, looked at like the last one.
            written.append(self._df)
            return write(self, *args, **kwargs)

        monkeypatch.setattr(DataFrameWriter, kind, noted)
    df = QUERIES[key](spark, SF_DIR)
    for frame in (*written, df):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        for slow in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert slow not in plan
    if key in ORACLES:
        assert oracle.differences(df, duck, ORACLES[key]) is None
    else:
        assert df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry_point.entry(spark).columns[0] == "fuel"
    assert entry_point.entry(spark).count() > 0


@pytest.mark.parametrize(
    "key,pushed",
    [
        ("pred_eq", "EqualTo(o_orderpriority,2-HIGH)"),
        ("pred_cmp", "GreaterThan(l_quantity,40.0)"),
        ("pred_in", "In(o_orderpriority"),
        ("select_query", "LessThan(o_totalprice,400000.0)"),
        ("plant_by_id", "EqualTo(c_custkey,7)"),
    ],
)
def test_filters_reach_the_scan(spark, key, pushed):
    assert pushed in QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["top_plants", "list_page", "limit_offset", "select_query", "nearby"])
def test_limits_are_top_k(spark, key):
    assert "TakeOrderedAndProject" in QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


def test_count_reads_no_text_columns(spark):
    plan = QUERIES["generation_trends"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan
