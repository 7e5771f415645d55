"""All registered queries: plans without nested loops or Python, and results equal to their SQL."""

import pytest
from pyspark.sql.readwriter import DataFrameWriter

import __spark_entry__ as entry_points
from scripts.differences import differences, open_oracle

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_points.QUERIES, entry_points.ORACLES


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()


def check_plan(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("NestedLoopJoin", "CartesianProduct", "EvalPython", "InPandas", "InArrow"):
        assert unwanted not in plan


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name, monkeypatch):
    # Intermediate tables have run before the last plan is seen, so each is looked at when it is written.
    write = DataFrameWriter.parquet

    def checked(self, *args, **more):
        check_plan(self._df)
        return write(self, *args, **more)

    monkeypatch.setattr(DataFrameWriter, "parquet", checked)
    df = QUERIES[name](spark, FOLDER)
    check_plan(df)
    assert differences(df.dtypes, df.collect(), oracle, ORACLES[name]) == []


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
