"""Read API over a warehouse: one function per dashboard read.

Each takes a ``Warehouse`` (test data or a refreshed catalog) and optional
filters, and returns a lazy DataFrame with lower-case columns.  Reads that
have a model mart fall back to the lag-1 / observed-demand versions when the
mart does not exist (A13), decided when the DataFrame is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from .operators import forecast_reads as fr
from .operators import kpis, quality, scoring
from .plans.warehouse import Warehouse


def platform_summary(w: Warehouse) -> DataFrame:
    return quality.platform_summary(w.inventory())


def pipeline_health(w: Warehouse) -> DataFrame:
    return quality.pipeline_health(w.inventory())


def quality_checks(w: Warehouse) -> DataFrame:
    return quality.quality_status(w.inventory())


def executive_metrics(w: Warehouse) -> DataFrame:
    return kpis.executive_metrics(w.fact_sales, w.fact_demand)


def sales_trend(w: Warehouse) -> DataFrame:
    return kpis.sales_trend(w.fact_sales)


def store_sales(w: Warehouse) -> DataFrame:
    return kpis.store_sales(w.fact_sales, w.dim_store)


def department_sales(w: Warehouse) -> DataFrame:
    return kpis.department_sales(w.fact_sales)


def demand_detail(w: Warehouse) -> DataFrame:
    return scoring.demand_detail(w.fact_demand)


def baseline_forecast(w: Warehouse) -> DataFrame:
    return fr.baseline_forecast(w.fact_sales)


def forecast_results(w: Warehouse) -> DataFrame:
    return fr.forecast_results(w.optional("fact_forecast"), w.fact_sales)


def forecast_filter_options(w: Warehouse) -> DataFrame:
    return fr.forecast_filter_options(w.optional("fact_forecast"), w.fact_sales)


def forecast_metrics(w: Warehouse, store_id: int | None = None, dept_id: int | None = None,
                     horizon_days: int | None = 0) -> DataFrame:
    return fr.forecast_metrics(w.optional("fact_forecast"), w.fact_sales, store_id, dept_id, horizon_days)


def forecast_trend(w: Warehouse, store_id: int | None = None, dept_id: int | None = None,
                   horizon_days: int | None = 0) -> DataFrame:
    return fr.forecast_trend(w.optional("fact_forecast"), w.fact_sales, store_id, dept_id, horizon_days)


def forecast_detail(w: Warehouse, store_id: int | None = None, dept_id: int | None = None,
                    horizon_days: int | None = 0, limit: int = 250) -> DataFrame:
    return fr.forecast_detail(w.optional("fact_forecast"), w.fact_sales, store_id, dept_id, horizon_days, limit)


def anomaly_candidates(w: Warehouse) -> DataFrame:
    return scoring.anomaly_candidates(w.fact_sales)


def stockout_risk_results(w: Warehouse) -> DataFrame:
    return scoring.stockout_queue(w.optional("fact_stockout_risk"), w.fact_demand)


def anomaly_results(w: Warehouse) -> DataFrame:
    return scoring.anomaly_queue(w.optional("fact_anomalies"), w.fact_sales)


READS = {
    name: fn for name, fn in globals().items()
    if callable(fn) and getattr(fn, "__module__", None) == __name__
}
