"""Every registered query against its SQL, and what the plans must not hold."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
from check_oracle import compare, connect
from shelfwatch.plans import oracles, queries

SF = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]
needs_data = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


NAMES = sorted(queries.queries())


def test_every_query_has_sql():
    assert set(NAMES) <= entry.queries().keys()
    assert set(NAMES) == oracles.oracle_sql().keys()


@needs_data
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, SF, name) is None


@needs_data
def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["device_type", "brand", "product_count"]


@needs_data
@pytest.mark.parametrize("name", sorted(set(NAMES) - {"incremental_load", "warehouse_history", "warehouse_create", "batch_job"}))
def test_plan_has_no_cross_join(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


@needs_data
def test_fact_scan_is_pruned(spark):
    plan = entry.queries()["daily_price_trend"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schema = re.search(r"lineitem.*?ReadSchema: struct<([^>]*)>", plan, re.S)
    assert "l_tax" not in (schema.group(1) if schema else plan)


def test_package_never_gathers_data():
    for path in (ROOT / "shelfwatch").rglob("*.py"):
        code = path.read_text()
        assert not re.search(r"\.(collect|toPandas|localCheckpoint|crossJoin|toLocalIterator)\(", code), path
        assert ".rdd" not in code and "F.udf" not in code, path
