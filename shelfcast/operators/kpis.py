"""Sales KPI reads over the marts.

Each function takes mart DataFrames and returns a lazy DataFrame; filters
and projections are left to Catalyst to push into the scans.  Money totals
are exact decimal sums (``money_sum``), so results do not depend on the
number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import EXECUTIVE_RISK_THRESHOLD, money, money_avg, money_sum
from ..plans.joins import small_side


def executive_metrics(fact_sales: DataFrame, fact_demand: DataFrame) -> DataFrame:
    """Global KPIs over sales LEFT demand on (store, dept, date).

    Duplicate keys fan out through both joins, as in the reference (T3).
    Zero or NULL inventory is not counted as high risk (T2).
    """
    s = fact_sales.select("store_id", "dept_id", "sales_date", "weekly_sales")
    d = fact_demand.select(
        F.col("store_id").alias("d_store_id"), F.col("dept_id").alias("d_dept_id"), "demand_date",
        "observed_demand", "available_inventory",
    )
    j = s.join(
        d, (s.store_id == d.d_store_id) & (s.dept_id == d.d_dept_id) & (s.sales_date == d.demand_date), "left"
    )
    ratio = F.try_divide(F.col("observed_demand"), F.nullif(F.col("available_inventory"), F.lit(0.0)))
    high = F.col("available_inventory").isNotNull() & (ratio > EXECUTIVE_RISK_THRESHOLD)
    totals = _totals(j, F.count_if(high).alias("__high"))
    return totals.agg(
        F.coalesce(F.sum("__money").cast("double"), F.lit(0.0)).alias("total_sales"), *_counts(),
        F.coalesce(F.sum("__high"), F.lit(0)).alias("high_or_critical_risk_count"),
    )


def _totals(sales: DataFrame, *more: Column) -> DataFrame:
    """One row a (store, department): exact money, rows, first and last date.

    Distinct stores and departments are then counted over these rows: over
    the sales themselves each row would be expanded once for either count.
    """
    return sales.groupBy("store_id", "dept_id").agg(
        F.sum(money("weekly_sales")).alias("__money"), F.count(F.lit(1)).alias("__rows"),
        F.min("sales_date").alias("__first"), F.max("sales_date").alias("__last"), *more)


def _counts() -> list[Column]:
    return [
        F.coalesce(F.sum("__rows"), F.lit(0)).alias("sales_records"),
        F.countDistinct("store_id").alias("store_count"),
        F.countDistinct("dept_id").alias("dept_count"),
        F.min("__first").alias("start_date"),
        F.max("__last").alias("end_date"),
    ]


def sales_trend(fact_sales: DataFrame) -> DataFrame:
    """Weekly totals with distinct stores and departments."""
    return (
        fact_sales.groupBy("sales_date")
        .agg(
            money_sum("weekly_sales").alias("weekly_sales"),
            F.countDistinct("store_id").alias("store_count"),
            F.countDistinct("dept_id").alias("dept_count"),
        )
        .orderBy("sales_date")
    )


def recent_trend(fact_sales: DataFrame, weeks: int = 20) -> DataFrame:
    """The latest ``weeks`` rows of the weekly trend (D2, question template)."""
    return sales_trend(fact_sales).orderBy(F.col("sales_date").desc()).limit(weeks)


def store_sales(fact_sales: DataFrame, dim_store: DataFrame) -> DataFrame:
    """Totals per store with store attributes."""
    ds = small_side(dim_store.select(F.col("store_id").alias("ds_store_id"), "store_type", "store_size"))
    j = fact_sales.select("store_id", "weekly_sales").join(ds, F.col("store_id") == F.col("ds_store_id"), "left")
    return (
        j.groupBy("store_id", "store_type", "store_size")
        .agg(
            money_sum("weekly_sales").alias("total_sales"),
            money_avg("weekly_sales").alias("avg_weekly_sales"),
            F.count(F.lit(1)).alias("sales_records"),
        )
        .orderBy(F.col("total_sales").desc_nulls_last(), "store_id")
    )


def department_sales(fact_sales: DataFrame) -> DataFrame:
    """Totals per department."""
    return (
        fact_sales.groupBy("dept_id")
        .agg(
            money_sum("weekly_sales").alias("total_sales"),
            money_avg("weekly_sales").alias("avg_weekly_sales"),
            F.count(F.lit(1)).alias("sales_records"),
        )
        .orderBy(F.col("total_sales").desc_nulls_last(), "dept_id")
    )


def top_stores(fact_sales: DataFrame, dim_store: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` stores by total sales; store id breaks ties."""
    return store_sales(fact_sales, dim_store).limit(n)


def top_departments(fact_sales: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` departments by total sales; dept id breaks ties."""
    return department_sales(fact_sales).limit(n)


def sales_totals(fact_sales: DataFrame) -> DataFrame:
    """Global totals of the sales fact."""
    return _totals(fact_sales).agg(F.sum("__money").cast("double").alias("total_sales"), *_counts())
