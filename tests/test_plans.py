"""Plan-shape checks: the scale properties are part of the contract."""

import re

from supplyscope.plans.catalog import queries

from .conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def _plan(spark, name):
    df = queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_one_exchange_and_no_python(spark):
    plan = _plan(spark, "forecast_ema_alerts")
    exchanges = re.findall(r"Exchange (\w+)\(([^)]*)\)", plan)
    assert len(exchanges) == 1, exchanges
    assert exchanges[0][0] == "hashpartitioning" and exchanges[0][1].startswith("ip#")
    assert not any(p in plan for p in PYTHON_NODES)
    # one window over the wide rows (the group's name), two over the series' non-null cells
    assert plan.count("Window [") == 3
    series, wide = plan.split("Generate inline")
    assert series.count("Window [") == 2 and wide.count("Window [") == 1
    assert "Filter isnotnull(valor#" in series


def test_linear_has_one_exchange(spark):
    plan = _plan(spark, "forecast_linear_alerts")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
    assert not any(p in plan for p in PYTHON_NODES)


def test_no_query_uses_python(spark):
    for name in queries():
        if name.startswith("stream") or name == "scan_all_classes":
            continue                                             # nested tables by row id need the page parser
        plan = _plan(spark, name)
        assert not any(p in plan for p in PYTHON_NODES), name


def test_page_extraction_is_map_only(spark):
    plan = _plan(spark, "gauges_to_supplies")
    assert "Exchange" not in plan


def test_readings_series_window_shares_the_aggregate_exchange(spark):
    plan = _plan(spark, "ema_last")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1
