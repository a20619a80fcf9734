"""Stockout risk and sales anomaly scoring, and their reads.

C4, B21-B23, F1, F4, F6, D11, D13 (stockout); E1, E5, B24, B25, F5, D12,
D14, B29 (anomalies).  Per-group z-scores use grouped statistics joined
back to the rows (``attach_group_stats``), never a window over a whole
(store, dept) group; the global z-score reads its statistics as scalar
subqueries.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ML_CONTRACTS
from ..functions.scalar import (
    DEFAULT_ANOMALY_THRESHOLD,
    RISK_ORDER,
    direction,
    money_avg,
    money_stddev_pop,
    no_negative_zero,
    recommended_action,
    risk_category,
    risk_rank,
    score_avg,
    severity,
    stockout_score,
)
from ..plans.groups import attach_group_stats

ANOMALY_MODEL_VERSION = "zscore_baseline_v1"  # fixed value
PROXY_MODEL_VERSION = "observed_demand_proxy"  # fixed value
SCORED_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)


# --------------------------------------------------------------------------
# stockout risk
# --------------------------------------------------------------------------
def score_stockout(df: DataFrame, predicted: str = "predicted_demand", inventory: str = "available_inventory") -> DataFrame:
    """Add score, class and action columns to any frame."""
    return (
        df.withColumn("stockout_risk_score", stockout_score(predicted, inventory))
        .withColumn("risk_category", risk_category("stockout_risk_score"))
        .withColumn("recommended_action", recommended_action("risk_category"))
    )


def stockout_output(demand_forecasts: DataFrame, stg_inventory: DataFrame | None) -> DataFrame:
    """ml.stockout_risk: horizon-0 forecasts INNER inventory, scored (C4).

    Without inventory the result is an empty frame of the full contract.
    """
    contract = ML_CONTRACTS["stockout_risk"].columns
    if stg_inventory is None:
        return demand_forecasts.sparkSession.createDataFrame([], contract)
    hist = demand_forecasts.where(F.col("horizon_days") == 0).select(
        "store", "dept", "forecast_date", "predicted_demand", "model_version", "created_at"
    )
    inv = stg_inventory.select(
        F.col("store_id").alias("i_store"), F.col("dept_id").alias("i_dept"), "inventory_date", "available_inventory"
    )
    j = hist.join(
        inv,
        (hist.store == inv.i_store) & (hist.dept == inv.i_dept) & (hist.forecast_date == inv.inventory_date),
        "inner",
    )
    scored = score_stockout(j)
    return scored.select(
        F.col("store").cast("int").alias("store"), F.col("dept").cast("int").alias("dept"),
        F.col("forecast_date").alias("risk_date"),
        F.round("predicted_demand", 2).alias("predicted_demand"),
        F.round("available_inventory", 2).alias("available_inventory"),
        no_negative_zero(F.round("stockout_risk_score", 4)).alias("stockout_risk_score"),
        "risk_category", "recommended_action", "model_version",
        F.col("created_at").cast("timestamp_ntz").alias("created_at"),
    )


def demand_detail(fact_demand: DataFrame) -> DataFrame:
    """Demand rows scored with observed demand as the prediction (F1)."""
    d = fact_demand.select(
        "store_id", "dept_id", "demand_date", "observed_demand", "available_inventory", "safety_stock_units",
        "reorder_point_units",
    )
    return score_stockout(d, "observed_demand", "available_inventory").orderBy("demand_date", "store_id", "dept_id")


def stockout_queue(fact_stockout_risk: DataFrame | None, fact_demand: DataFrame) -> DataFrame:
    """Critical first, then highest score (F4); observed-demand proxy otherwise."""
    if fact_stockout_risk is None:
        src = demand_detail(fact_demand).select(
            "store_id", "dept_id", F.col("demand_date").alias("risk_date"),
            F.col("observed_demand").alias("predicted_demand"), "available_inventory", "stockout_risk_score",
            "risk_category", "recommended_action", F.lit(PROXY_MODEL_VERSION).alias("model_version"),
        )
    else:
        src = fact_stockout_risk.select(
            "store_id", "dept_id", "risk_date", "predicted_demand", "available_inventory", "stockout_risk_score",
            "risk_category", "recommended_action", "model_version",
        )
    return src.orderBy(
        risk_rank("risk_category"), F.col("stockout_risk_score").desc_nulls_first(), "risk_date", "store_id", "dept_id"
    )


def top_stockout(fact_stockout_risk: DataFrame, n: int = 10) -> DataFrame:
    """Highest ``n`` scores; key columns break ties."""
    return fact_stockout_risk.select(
        "store_id", "dept_id", "risk_date", "predicted_demand", "available_inventory", "stockout_risk_score",
        "risk_category", "recommended_action",
    ).orderBy(
        F.col("stockout_risk_score").desc_nulls_first(), "risk_date", "store_id", "dept_id"
    ).limit(n)


def risk_summary(fact_stockout_risk: DataFrame) -> DataFrame:
    """Rows, mean and max score per class, in severity order."""
    g = fact_stockout_risk.groupBy("risk_category").agg(
        F.count(F.lit(1)).alias("risk_rows"),
        score_avg("stockout_risk_score").alias("avg_risk_score"),
        F.max("stockout_risk_score").alias("max_risk_score"),
    )
    return g.orderBy(risk_rank("risk_category"), "risk_category")


def risk_distribution(scored: DataFrame) -> DataFrame:
    """Rows per class, all four present, fixed order."""
    spark = scored.sparkSession
    classes = spark.createDataFrame(
        [(name, i) for i, name in enumerate(RISK_ORDER)],
        T.StructType([T.StructField("risk_category", T.StringType()), T.StructField("risk_order", T.IntegerType())]),
    )
    counts = scored.groupBy(F.col("risk_category").alias("c_category")).agg(F.count(F.lit(1)).alias("n"))
    j = F.broadcast(classes).join(counts, F.col("risk_category") == F.col("c_category"), "left")
    return j.select("risk_category", F.coalesce("n", F.lit(0)).cast("bigint").alias("risk_count"), "risk_order").orderBy(
        "risk_order"
    ).drop("risk_order")


# --------------------------------------------------------------------------
# anomalies
# --------------------------------------------------------------------------
def _zscore(value: str) -> F.Column:
    """z from attached __mean/__std/__min/__max; constant or NULL-std groups -> 0."""
    constant = F.col("__std").isNull() | (F.col("__std") == 0) | (F.col("__min") == F.col("__max"))
    return F.when(constant, F.lit(0.0)).otherwise((F.col(value) - F.col("__mean")) / F.col("__std"))


def _stats(value: str) -> dict[str, F.Column]:
    return {
        "__mean": money_avg(value),
        "__std": money_stddev_pop(value),
        "__min": F.min(value),
        "__max": F.max(value),
    }


def detect_sales_anomalies(sales: DataFrame, threshold: float = DEFAULT_ANOMALY_THRESHOLD,
                           keys: tuple[str, ...] = ("store_id", "dept_id"), value: str = "weekly_sales") -> DataFrame:
    """z-score within each group; flag |z| >= threshold."""
    scored = attach_group_stats(sales, list(keys), _stats(value))
    z = _zscore(value)
    return scored.select(
        *sales.columns,
        z.alias("anomaly_score"),
        F.coalesce(F.abs(z) >= threshold, F.lit(False)).alias("is_anomaly"),
        severity(z, threshold).alias("severity"),
        direction(z).alias("direction"),
    )


def sales_anomaly_output(stg_sales: DataFrame, threshold: float = DEFAULT_ANOMALY_THRESHOLD,
                         created_at: _dt.datetime = SCORED_AT) -> DataFrame:
    """ml.sales_anomalies: z to 4 places, sales to 2."""
    s = stg_sales.select(
        F.col("store_id").alias("store"), F.col("dept_id").alias("dept"), F.col("sales_date"), "weekly_sales"
    )
    d = detect_sales_anomalies(s, threshold, keys=("store", "dept"))
    return d.select(
        "store", "dept", "sales_date",
        F.round("weekly_sales", 2).alias("weekly_sales"),
        no_negative_zero(F.round("anomaly_score", 4)).alias("anomaly_score"),
        "is_anomaly", "severity", "direction",
        F.lit(ANOMALY_MODEL_VERSION).alias("model_version"),
        F.lit(created_at).cast("timestamp_ntz").alias("created_at"),
    )


def flag_zscore_anomalies(df: DataFrame, value: str, threshold: float = 3.0) -> DataFrame:
    """Global z-score over the whole frame (E5).

    The statistics are one struct-valued scalar subquery (a single partial +
    final aggregate, computed once and inlined into the scan); no window
    without a partition and no join."""
    stats = df.select(F.struct(*[v.alias(k) for k, v in _stats(value).items()])).scalar()
    j = df.select("*", *[stats.getField(k).alias(k) for k in _stats(value)])
    z = _zscore(value)
    return j.select(
        *df.columns, z.alias("anomaly_score"), F.coalesce(F.abs(z) >= threshold, F.lit(False)).alias("is_anomaly")
    )


def anomaly_candidates(fact_sales: DataFrame, threshold: float = DEFAULT_ANOMALY_THRESHOLD) -> DataFrame:
    """Phase-1.5 global screen at 2.0; flagged first, then signed z."""
    s = fact_sales.select("store_id", "dept_id", "sales_date", "weekly_sales")
    f = flag_zscore_anomalies(s, "weekly_sales", threshold)
    return f.select(
        "*", severity("anomaly_score", 2.0).alias("severity"), direction("anomaly_score").alias("direction")
    ).orderBy(F.col("is_anomaly").desc(), F.col("anomaly_score").desc_nulls_last(), "sales_date", "store_id", "dept_id")


def anomaly_queue(fact_anomalies: DataFrame | None, fact_sales: DataFrame) -> DataFrame:
    """Flagged first, largest |z| first, then date (F5); global screen otherwise."""
    if fact_anomalies is None:
        return anomaly_candidates(fact_sales)
    a = fact_anomalies.select(
        "store_id", "dept_id", "sales_date", "weekly_sales", "anomaly_score", "is_anomaly", "severity", "direction",
        "model_version",
    )
    return a.orderBy(
        F.col("is_anomaly").desc(), F.abs("anomaly_score").desc_nulls_last(), "sales_date", "store_id", "dept_id"
    )


def triage(anomalies: DataFrame, severity_filter: str = "All", direction_filter: str = "All") -> DataFrame:
    """Severity and/or direction filter; "All" keeps everything."""
    if severity_filter != "All":
        anomalies = anomalies.where(F.col("severity") == severity_filter)
    if direction_filter != "All":
        anomalies = anomalies.where(F.col("direction") == direction_filter)
    return anomalies


def anomaly_summary(fact_anomalies: DataFrame) -> DataFrame:
    """Flagged rows per (severity, direction) with mean |z|."""
    return (
        fact_anomalies.where(F.col("is_anomaly"))
        .groupBy("severity", "direction")
        .agg(F.count(F.lit(1)).alias("anomaly_rows"), money_avg(F.abs("anomaly_score")).alias("avg_abs_anomaly_score"))
        .orderBy(F.col("anomaly_rows").desc(), "severity", "direction")
    )


def anomaly_kpis(anomalies: DataFrame) -> DataFrame:
    """Candidate rows, flagged rows, largest |z|."""
    return anomalies.agg(
        F.count(F.lit(1)).alias("candidate_rows"),
        F.count_if(F.col("is_anomaly")).alias("flagged_rows"),
        F.max(F.abs("anomaly_score")).alias("max_abs_score"),
    )
