"""Dimension and fact marts.

``fact_sales``, ``fact_inventory`` and ``fact_demand`` share the key
(store_id, dept_id, date).  Joins between them are equi-joins on that key;
the store dimension is joined through ``small_side`` (broadcast only under
a planner size check, AQE otherwise).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import day_of_week_sunday0
from ..plans.joins import small_side


def fact_sales(stg_sales: DataFrame) -> DataFrame:
    return stg_sales.select("store_id", "dept_id", "sales_date", "weekly_sales", "is_holiday", "source_file", "loaded_at")


def fact_inventory(stg_inventory: DataFrame) -> DataFrame:
    return stg_inventory.select(
        "store_id", "dept_id", "inventory_date", "sku", "available_inventory", "safety_stock_units",
        "reorder_point_units", "source_file", "loaded_at",
    )


def fact_demand(stg_sales: DataFrame, stg_inventory: DataFrame) -> DataFrame:
    """Sales LEFT inventory on (store, dept, date)."""
    s = stg_sales.select("store_id", "dept_id", "sales_date", "weekly_sales")
    i = stg_inventory.select(
        F.col("store_id").alias("i_store_id"), F.col("dept_id").alias("i_dept_id"), "inventory_date",
        "available_inventory", "safety_stock_units", "reorder_point_units",
    )
    joined = s.join(
        i,
        (s.store_id == i.i_store_id) & (s.dept_id == i.i_dept_id) & (s.sales_date == i.inventory_date),
        "left",
    )
    return joined.select(
        "store_id", "dept_id", F.col("sales_date").alias("demand_date"), F.col("weekly_sales").alias("observed_demand"),
        "available_inventory", "safety_stock_units", "reorder_point_units",
    )


def dim_store(stg_stores: DataFrame) -> DataFrame:
    """Distinct (store_id, store_type, store_size)."""
    return stg_stores.select("store_id", "store_type", "store_size").distinct()


def dim_date(stg_sales: DataFrame, stg_features: DataFrame, stg_inventory: DataFrame) -> DataFrame:
    """Calendar of every date in sales, features and inventory (G1).

    The distinct is partially aggregated in every input partition before the
    shuffle, which then carries one row per (partition, date) instead of
    every fact row.
    """
    dates = (
        stg_sales.select(F.col("sales_date").alias("date_day"))
        .union(stg_features.select(F.col("feature_date").alias("date_day")))
        .union(stg_inventory.select(F.col("inventory_date").alias("date_day")))
        .where(F.col("date_day").isNotNull())
        .distinct()
    )
    return dates.select(
        "date_day",
        F.year("date_day").alias("year"),
        F.quarter("date_day").alias("quarter"),
        F.month("date_day").alias("month"),
        F.weekofyear("date_day").alias("week_of_year"),
        day_of_week_sunday0("date_day").alias("day_of_week"),
    )


def int_sales_features(stg_sales: DataFrame, stg_stores: DataFrame, stg_features: DataFrame) -> DataFrame:
    """Sales LEFT stores (store) LEFT features (store, date)."""
    s = stg_sales.select("store_id", "dept_id", "sales_date", "weekly_sales", "is_holiday")
    st = small_side(
        stg_stores.select(F.col("store_id").alias("st_store_id"), "store_type", "store_size")
    )
    fe = stg_features.select(
        F.col("store_id").alias("f_store_id"), "feature_date", "temperature", "fuel_price",
        "markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi", "unemployment",
    )
    joined = s.join(st, s.store_id == st.st_store_id, "left").join(
        fe, (s.store_id == fe.f_store_id) & (s.sales_date == fe.feature_date), "left"
    )
    return joined.select(
        "store_id", "dept_id", "sales_date", "weekly_sales", "is_holiday", "store_type", "store_size",
        "temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi",
        "unemployment",
    )


def fact_forecast(demand_forecasts: DataFrame) -> DataFrame:
    """Typed forecast mart over ml.demand_forecasts."""
    return demand_forecasts.select(
        F.col("store").cast("int").alias("store_id"),
        F.col("dept").cast("int").alias("dept_id"),
        F.col("forecast_date").cast("date").alias("forecast_date"),
        F.col("horizon_days").cast("int").alias("horizon_days"),
        F.col("predicted_demand").cast("double").alias("predicted_demand"),
        F.col("actual_demand").cast("double").alias("actual_demand"),
        F.col("prediction_interval_lower").cast("double").alias("prediction_interval_lower"),
        F.col("prediction_interval_upper").cast("double").alias("prediction_interval_upper"),
        F.col("model_name").cast("string").alias("model_name"),
        F.col("model_version").cast("string").alias("model_version"),
        _ntz("trained_at").alias("trained_at"),
        _ntz("created_at").alias("created_at"),
    )


def fact_stockout_risk(stockout_risk: DataFrame) -> DataFrame:
    """Typed stockout mart over ml.stockout_risk."""
    return stockout_risk.select(
        F.col("store").cast("int").alias("store_id"),
        F.col("dept").cast("int").alias("dept_id"),
        F.col("risk_date").cast("date").alias("risk_date"),
        F.col("predicted_demand").cast("double").alias("predicted_demand"),
        F.col("available_inventory").cast("double").alias("available_inventory"),
        F.col("stockout_risk_score").cast("double").alias("stockout_risk_score"),
        F.col("risk_category").cast("string").alias("risk_category"),
        F.col("recommended_action").cast("string").alias("recommended_action"),
        F.col("model_version").cast("string").alias("model_version"),
        _ntz("created_at").alias("created_at"),
    )


def fact_anomalies(sales_anomalies: DataFrame) -> DataFrame:
    """Typed anomaly mart over ml.sales_anomalies."""
    return sales_anomalies.select(
        F.col("store").cast("int").alias("store_id"),
        F.col("dept").cast("int").alias("dept_id"),
        F.col("sales_date").cast("date").alias("sales_date"),
        F.col("weekly_sales").cast("double").alias("weekly_sales"),
        F.col("anomaly_score").cast("double").alias("anomaly_score"),
        F.col("is_anomaly").cast("boolean").alias("is_anomaly"),
        F.col("severity").cast("string").alias("severity"),
        F.col("direction").cast("string").alias("direction"),
        F.col("model_version").cast("string").alias("model_version"),
        _ntz("created_at").alias("created_at"),
    )


def _ntz(name: str) -> F.Column:
    """Tolerant timestamp parse: already typed values pass, text is parsed, bad -> NULL."""
    return F.col(name).cast("string").try_cast("timestamp_ntz")


INT_SALES_FEATURES_SQL = """SELECT s.store_id, s.dept_id, s.sales_date, s.weekly_sales, s.is_holiday, st.store_type,
  st.store_size, f.temperature, f.fuel_price, f.markdown1, f.markdown2, f.markdown3, f.markdown4, f.markdown5, f.cpi,
  f.unemployment
FROM {db}.stg_sales AS s
LEFT JOIN {db}.stg_stores AS st ON s.store_id = st.store_id
LEFT JOIN {db}.stg_features AS f ON s.store_id = f.store_id AND s.sales_date = f.feature_date"""
