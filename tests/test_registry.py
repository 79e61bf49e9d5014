"""Every registered query against its SQL twin on the smallest tables, and its plan."""

import re

import pytest

import __spark_entry__ as entry
from compare import difference, duck
from tidewell import registry

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(registry.all_queries())
# queries whose result is written before it is read: their plan shows only the last read
LAZY = [n for g in registry.GROUPS if g.__name__.rsplit(".", 1)[1] not in ("storage", "incremental") for n in g.QUERIES]


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    """The queries run as they do outside tests: with generated code."""
    changed = {"spark.sql.codegen.wholeStage": "true", "spark.sql.codegen.factoryMode": "FALLBACK"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_same_result_as_sql(spark, con, name):
    assert difference(spark, con, name, registry.all_queries()[name], registry.all_oracles()[name], SF_DIR) is None


def test_every_query_has_sql():
    assert set(registry.all_queries()) == set(registry.all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.all_queries()) <= set(entry.queries())
    assert entry.entry.__doc__


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(LAZY))
def test_plan(spark, name):
    plan = registry.all_queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|PythonUDF|MapInPandas|EvalPython|ObjectHashAggregate.*collect_set", plan)


def test_filters_and_columns_reach_the_scan(spark):
    from tidewell.registry import statistics as S

    plan = S.entity_range(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(event_type,purchase)" in pushed and "GreaterThanOrEqual(ts" in pushed
    plan = S.date_range(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan[plan.index("PushedFilters"):]
    plan = S.entity_list(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_type:string>" in plan
