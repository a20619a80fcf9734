"""Forecast reads: the lag-1 baseline and the forecast mart queries.

E2 (lag-1 baseline), B35 (its forecast shape), D7/D8 (its metrics and
trend), F2, D5, D6, F3, D9, D15, B30 over ``fact_forecast`` with B26
optional filters, and the A13 switch that serves the baseline when the
forecast mart is absent.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import interval_lower, interval_upper, money, money_sum, wape
from ..plans.groups import attach_group_stats, latest_per_group, previous_in_group

BASELINE_MODEL_NAME = "phase_1_5_naive_baseline"  # fixed value
BASELINE_MODEL_VERSION = "phase_1_5"  # fixed value
NEXT_WEEK_DAYS = 7
# Stamps of the deterministic lag forecast: fixed so repeated runs agree.
BASELINE_RUN_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)

KEYS = ["store_id", "dept_id"]


def baseline_forecast(fact_sales: DataFrame) -> DataFrame:
    """Previous week's sales per (store, dept); first week -> group mean.

    The mean is over all weeks of the group, future ones included (T16).
    """
    s = fact_sales.select("store_id", "dept_id", "sales_date", "weekly_sales")
    lagged = previous_in_group(s, KEYS, ["sales_date", "weekly_sales"], "weekly_sales", "__lag")
    lagged = attach_group_stats(
        lagged, KEYS, {"__mean": F.try_divide(money_sum("weekly_sales"), F.count("weekly_sales").cast("double"))},
        source=s,
    )
    return lagged.select(
        "store_id", "dept_id", "sales_date", "weekly_sales",
        F.coalesce(F.col("__lag"), F.col("__mean")).alias("baseline_forecast"),
    ).select(
        "*",
        (F.col("weekly_sales") - F.col("baseline_forecast")).alias("forecast_error"),
        F.abs(F.col("weekly_sales") - F.col("baseline_forecast")).alias("absolute_error"),
    )


def filter_keys(df: DataFrame, store_id: int | None = None, dept_id: int | None = None,
                horizon_days: int | None = None) -> DataFrame:
    """Optional equality filters; only given ones apply."""
    for name, value in (("store_id", store_id), ("dept_id", dept_id), ("horizon_days", horizon_days)):
        if value is not None:
            df = df.where(F.col(name) == F.lit(int(value)))
    return df


def lag_forecast_output(fact_sales: DataFrame, run_at: _dt.datetime = BASELINE_RUN_AT) -> DataFrame:
    """ml.demand_forecasts from the lag baseline: horizon 0 rows plus one
    next-week row per (store, dept) carrying the last observed value."""
    base = baseline_forecast(fact_sales)
    observed = base.select(
        F.col("store_id").alias("store"), F.col("dept_id").alias("dept"), F.col("sales_date").alias("forecast_date"),
        F.lit(0).alias("horizon_days"), F.col("baseline_forecast").alias("predicted_demand"),
        F.col("weekly_sales").alias("actual_demand"),
    )
    last = latest_per_group(
        fact_sales.select("store_id", "dept_id", "sales_date", "weekly_sales"), KEYS, ["sales_date", "weekly_sales"]
    )
    future = last.select(
        F.col("store_id").alias("store"), F.col("dept_id").alias("dept"),
        F.date_add("sales_date", NEXT_WEEK_DAYS).alias("forecast_date"), F.lit(NEXT_WEEK_DAYS).alias("horizon_days"),
        F.col("weekly_sales").alias("predicted_demand"), F.lit(None).cast("double").alias("actual_demand"),
    )
    ts = F.lit(run_at).cast("timestamp_ntz")
    return observed.unionByName(future).select(
        "*",
        interval_lower("predicted_demand").alias("prediction_interval_lower"),
        interval_upper("predicted_demand").alias("prediction_interval_upper"),
        F.lit(BASELINE_MODEL_NAME).alias("model_name"), F.lit(BASELINE_MODEL_VERSION).alias("model_version"),
        ts.alias("trained_at"), ts.alias("created_at"),
    )


def baseline_forecast_shape(fact_sales: DataFrame) -> DataFrame:
    """The baseline renamed to forecast columns."""
    b = baseline_forecast(fact_sales)
    return b.select(
        "store_id", "dept_id", F.col("sales_date").alias("forecast_date"), F.lit(0).alias("horizon_days"),
        F.col("baseline_forecast").alias("predicted_demand"), F.col("weekly_sales").alias("actual_demand"),
        interval_lower("baseline_forecast").alias("prediction_interval_lower"),
        interval_upper("baseline_forecast").alias("prediction_interval_upper"),
        F.lit(BASELINE_MODEL_NAME).alias("model_name"), F.lit(BASELINE_MODEL_VERSION).alias("model_version"),
        "forecast_error", "absolute_error",
    )


def _errors(df: DataFrame) -> list[F.Column]:
    return [
        (F.col("actual_demand") - F.col("predicted_demand")).alias("forecast_error"),
        F.abs(F.col("actual_demand") - F.col("predicted_demand")).alias("absolute_error"),
    ]


def forecast_results(fact_forecast: DataFrame | None, fact_sales: DataFrame) -> DataFrame:
    """Forecast rows with error columns; baseline when the mart is absent."""
    if fact_forecast is None:
        return baseline_forecast_shape(fact_sales).orderBy("forecast_date", "store_id", "dept_id")
    return fact_forecast.select(
        "store_id", "dept_id", "forecast_date", "horizon_days", "predicted_demand", "actual_demand",
        "prediction_interval_lower", "prediction_interval_upper", "model_name", "model_version",
        *_errors(fact_forecast),
    ).orderBy("forecast_date", "store_id", "dept_id")


def forecast_metrics(fact_forecast: DataFrame | None, fact_sales: DataFrame, store_id: int | None = None,
                     dept_id: int | None = None, horizon_days: int | None = 0) -> DataFrame:
    """Summary metrics in the engine (D5); baseline metrics otherwise."""
    if fact_forecast is None:
        return baseline_metrics(fact_sales, store_id, dept_id)
    f = filter_keys(fact_forecast, store_id, dept_id, horizon_days)
    return f.agg(
        F.coalesce(money_sum("predicted_demand"), F.lit(0.0)).alias("predicted_demand"),
        F.coalesce(money_sum("actual_demand"), F.lit(0.0)).alias("actual_demand"),
        wape("actual_demand", "predicted_demand").alias("wape"),
        F.count(F.lit(1)).alias("forecast_rows"),
        F.count_if(F.col("actual_demand").isNotNull()).alias("scored_rows"),
        F.min("forecast_date").alias("start_date"),
        F.max("forecast_date").alias("end_date"),
    )


def forecast_trend(fact_forecast: DataFrame | None, fact_sales: DataFrame, store_id: int | None = None,
                   dept_id: int | None = None, horizon_days: int | None = 0) -> DataFrame:
    """Weekly predicted/actual totals and WAPE (D6); baseline trend otherwise."""
    if fact_forecast is None:
        return baseline_trend(fact_sales, store_id, dept_id)
    f = filter_keys(fact_forecast, store_id, dept_id, horizon_days)
    return (
        f.groupBy("forecast_date")
        .agg(
            money_sum("predicted_demand").alias("predicted_demand"),
            money_sum("actual_demand").alias("actual_demand"),
            wape("actual_demand", "predicted_demand").alias("wape"),
            F.count(F.lit(1)).alias("forecast_rows"),
        )
        .orderBy("forecast_date")
    )


def forecast_detail(fact_forecast: DataFrame | None, fact_sales: DataFrame, store_id: int | None = None,
                    dept_id: int | None = None, horizon_days: int | None = 0, limit: int = 250) -> DataFrame:
    """Capped detail: latest dates first, largest error first.

    The cap is the feature (a top-k report); Spark plans it as a
    TakeOrderedAndProject, so each task keeps only its own top ``limit``.
    """
    if fact_forecast is None:
        b = filter_keys(baseline_forecast_shape(fact_sales), store_id, dept_id)
        return b.select(
            "store_id", "dept_id", "forecast_date", "actual_demand", "predicted_demand", "forecast_error",
            "absolute_error", F.lit(0).alias("horizon_days"), F.lit(BASELINE_MODEL_VERSION).alias("model_version"),
        ).orderBy(F.col("absolute_error").desc_nulls_last(), "forecast_date", "store_id", "dept_id").limit(limit)
    f = filter_keys(fact_forecast, store_id, dept_id, horizon_days)
    return f.select(
        "forecast_date", "store_id", "dept_id", "horizon_days", "actual_demand", "predicted_demand",
        "prediction_interval_lower", "prediction_interval_upper", *_errors(f), "model_version",
    ).orderBy(
        F.col("forecast_date").desc(), F.col("absolute_error").desc_nulls_last(), "store_id", "dept_id"
    ).limit(limit)


def forecast_long(trend: DataFrame) -> DataFrame:
    """Trend in long form (date, series, demand) without NULL demand."""
    long = trend.unpivot(
        ["forecast_date"], ["actual_demand", "predicted_demand"], "series", "demand"
    )
    return long.dropna(subset=["demand"])


def weekly_error_rows(trend: DataFrame) -> DataFrame:
    """Trend rows that carry a WAPE."""
    return trend.where(F.col("wape").isNotNull())


def forecast_filter_options(fact_forecast: DataFrame | None, fact_sales: DataFrame) -> DataFrame:
    """Distinct (store, dept, horizon) choices."""
    if fact_forecast is None:
        src = fact_sales.select("store_id", "dept_id", F.lit(0).alias("horizon_days"))
    else:
        src = fact_forecast.select("store_id", "dept_id", "horizon_days")
    return src.distinct().orderBy("store_id", "dept_id", "horizon_days")


def accuracy_by_version(fact_forecast: DataFrame) -> DataFrame:
    """Rows, totals and WAPE per model version; horizons mixed."""
    return (
        fact_forecast.groupBy("model_version")
        .agg(
            F.count(F.lit(1)).alias("forecast_rows"),
            money_sum("predicted_demand").alias("predicted_demand"),
            money_sum("actual_demand").alias("actual_demand"),
            wape("actual_demand", "predicted_demand").alias("wape"),
        )
        .orderBy(F.col("forecast_rows").desc(), "model_version")
    )


def baseline_metrics(fact_sales: DataFrame, store_id: int | None = None, dept_id: int | None = None) -> DataFrame:
    """Metrics of the lag baseline; WAPE 0 on a zero denominator."""
    b = filter_keys(baseline_forecast(fact_sales), store_id, dept_id)
    den = F.coalesce(F.sum(F.abs(money("weekly_sales"))).cast("double"), F.lit(0.0))
    num = F.coalesce(F.sum(money("absolute_error")).cast("double"), F.lit(0.0))
    return b.agg(
        F.coalesce(money_sum("baseline_forecast"), F.lit(0.0)).alias("predicted_demand"),
        F.coalesce(money_sum("weekly_sales"), F.lit(0.0)).alias("actual_demand"),
        F.when(den == 0, F.lit(0.0)).otherwise(F.try_divide(num, den)).alias("wape"),
        F.count(F.lit(1)).alias("forecast_rows"),
        F.count(F.lit(1)).alias("scored_rows"),
        F.min("sales_date").alias("start_date"),
        F.max("sales_date").alias("end_date"),
    )


def baseline_trend(fact_sales: DataFrame, store_id: int | None = None, dept_id: int | None = None) -> DataFrame:
    """Weekly baseline trend: error = |sum actual - sum predicted|."""
    b = filter_keys(baseline_forecast(fact_sales), store_id, dept_id)
    g = b.groupBy(F.col("sales_date").alias("forecast_date")).agg(
        F.coalesce(money_sum("weekly_sales"), F.lit(0.0)).alias("actual_demand"),
        F.coalesce(money_sum("baseline_forecast"), F.lit(0.0)).alias("predicted_demand"),
        F.count(F.lit(1)).alias("forecast_rows"),
    )
    err = F.abs(F.col("actual_demand") - F.col("predicted_demand"))
    return g.select(
        "*", err.alias("absolute_error"),
        F.try_divide(err, F.nullif(F.abs(F.col("actual_demand")), F.lit(0.0))).alias("wape"),
    ).orderBy("forecast_date")
