"""Adapter tables at sf0.01 have the published fixture properties."""

from pyspark.sql import functions as F

from shelfcast.plans.registry import QUERIES
from shelfcast.plans.warehouse import Warehouse

from conftest import SF_CHECK


def test_adapter_counts_and_properties(spark):
    w = Warehouse.shared(spark, SF_CHECK)
    s, i, f = w.stg_sales, w.stg_inventory, w.stg_features
    assert (s.count(), w.stg_stores.count(), f.count(), i.count()) == (40928, 25, 7054, 39216)
    assert s.select("store_id", "dept_id").distinct().count() == 250
    assert s.select("sales_date").distinct().count() == 357
    assert i.where(F.col("available_inventory") == 0).count() == 373
    assert w.fact_demand.where(F.col("available_inventory").isNull()).count() == 1712
    assert w.int_sales_features.where(F.col("fuel_price").isNull()).count() == 8496
    assert f.where(F.col("unemployment").isNull()).count() == 1387
    assert s.where("is_holiday").count() == 2954


def test_risk_classes_and_executive_count(spark):
    dist = {r["risk_category"]: r["risk_count"] for r in QUERIES["risk_distribution_proxy"](spark, SF_CHECK).collect()}
    assert dist == {"Low": 8822, "Medium": 12443, "High": 4827, "Critical": 14836}
    assert QUERIES["executive_metrics"](spark, SF_CHECK).first()["high_or_critical_risk_count"] == 17578
