"""Plan checks: no Python in any query plan, no unpartitioned window,
size-checked broadcast of the store dimension, pushdown into the scans."""

import re

import pytest

from shelfcast.plans.registry import QUERIES

from conftest import SF_SMALL

SKIP = {"forest_forecast", "holdout_metrics"}  # these train a model while building


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SKIP))
def test_plan_is_jvm_only_and_partitioned(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    assert not re.search(r"EvalPython|PythonUDF|FlatMapGroupsInPandas|MapInPandas", plan), name
    for line in plan.splitlines():
        if re.match(r"\s*[:+\- ]*Window \[", line):
            assert "], [], [" not in line, f"{name}: window without partition: {line}"


def test_store_dimension_is_broadcast(spark):
    from shelfcast.operators import kpis
    from shelfcast.plans.warehouse import Warehouse

    w = Warehouse.from_testdata(spark, SF_SMALL)
    plan = _plan(kpis.store_sales(w.fact_sales, w.dim_store))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_scan_pruning_and_pushdown(spark):
    from shelfcast.sources.adapter import sales_frame

    plan = _plan(sales_frame(spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "lineitem" in line][0]
    assert "l_comment" not in scan and "l_orderkey" not in scan  # only the needed columns are read
    # An optional store filter (B26) reaches the supplier scan of the adapter.
    from shelfcast.operators.forecast_reads import filter_keys
    from shelfcast.plans.warehouse import Warehouse

    fs = Warehouse.from_testdata(spark, SF_SMALL).fact_sales
    plan = _plan(filter_keys(fs, store_id=3))
    scan = [line for line in plan.splitlines() if "supplier" in line][0]
    assert "EqualTo(s_nationkey,3)" in scan


def test_lag_baseline_has_one_join_and_no_sort_aggregate(spark):
    """The lag adds no join (chunk heads come from hash aggregates), its
    windows are partitioned by (group, date) or by group over per-date rows,
    and the only join it adds attaches the group mean."""
    from shelfcast.operators import forecast_reads
    from shelfcast.plans.warehouse import Warehouse

    w = Warehouse.from_testdata(spark, SF_SMALL)
    plan = _plan(forecast_reads.baseline_forecast(w.fact_sales))
    assert "SortAggregate" not in plan
    joins = [l for l in plan.splitlines() if re.search(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin) \[", l)]
    assert sum("__g_" in l for l in joins) == 1
    assert not any("__p_" in l or "__b_" in l for l in joins)
    windows = [l for l in plan.splitlines() if re.match(r"\s*[:+\- ]*Window \[", l)]
    assert len(windows) == 2
    assert any("__p_chunk" in l.split("], [")[-2] for l in windows)
