"""Every registered query against its SQL, and the shape of every plan."""

import pytest

import __spark_entry__ as entry
from compare import difference, open_oracle
from refinery.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def oracle():
    return open_oracle(FOLDER)


@pytest.fixture(scope="module")
def frames(spark):
    built = {}

    def frame(name):
        if name not in built:
            built[name] = entry.queries()[name](spark, FOLDER)
        return built[name]

    return frame


@pytest.mark.parametrize("name", NAMES)
def test_agrees_with_sql(name, frames, oracle):
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert frames(name).count() > 0
    else:
        assert difference(frames(name), oracle, sql) is None


@pytest.mark.parametrize("name", NAMES)
def test_plan_stays_in_spark(name, frames):
    plan = frames(name)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas", "ExistingRDD"):
        assert node not in plan


def test_sql_without_query_is_a_mistake():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 6


def test_comparison_notices_differences(spark, oracle):
    frame = spark.sql("SELECT 1L AS a")
    assert difference(frame, oracle, "SELECT CAST(1 AS BIGINT) AS a") is None
    assert "rows" in difference(frame, oracle, "SELECT CAST(2 AS BIGINT) AS a")
    assert "columns" in difference(frame, oracle, "SELECT CAST(1 AS BIGINT) AS b")
    assert "types" in difference(frame, oracle, "SELECT CAST(1 AS INTEGER) AS a")
