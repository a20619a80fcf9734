"""Synthetic inventory and weather from sales and feature rows (H5, H6).

Random draws come from ``xxhash64`` of the row key, the seed and a stream
number, so a row gets the same draws however the data is partitioned or
re-executed after a lost executor (``F.rand`` depends on partitioning).
Normals use Box-Muller; the Gamma draw uses a table of quantiles built from
the shape parameter at import, even in the logarithm of the tail's
probability, and interpolated inside the expression.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import require_columns
from ..functions.scalar import sku
from .selection import exact_medians

LOW_INVENTORY_SHARE = 0.18
COVERAGE_MEAN, COVERAGE_SD = 1.25, 0.28
COVERAGE_CLIP = (0.65, 2.05)
LOW_COVERAGE = (0.35, 0.95)
SAFETY_SHARE = (0.18, 0.32)
REORDER_SHARE = (0.25, 0.45)
PRECIP_SHAPE, PRECIP_SCALE, PRECIP_MAX = 1.2, 0.08, 1.5
SNOW_BELOW_TEMPERATURE = 35.0
SNOW_SHARE = (0.2, 1.1)
GAMMA_TABLE_SIZE = 1024
GAMMA_TAIL = 30.0  # -log of the least tail probability in the table

_UNIT = float(1 << 53)


def uniform(seed: int, stream: int, *key: Column) -> Column:
    """A U[0, 1) draw fixed by (key, seed, stream)."""
    h = F.xxhash64(*key, F.lit(seed), F.lit(stream))
    return F.shiftrightunsigned(h, 11).cast("double") / F.lit(_UNIT)


def uniform_between(lo: float, hi: float, seed: int, stream: int, *key: Column) -> Column:
    return F.lit(lo) + (F.lit(hi) - F.lit(lo)) * uniform(seed, stream, *key)


def normal(mean: float, sd: float, seed: int, stream: int, *key: Column) -> Column:
    u1 = F.lit(1.0) - uniform(seed, stream, *key)  # (0, 1]
    u2 = uniform(seed, stream + 1, *key)
    return F.lit(mean) + F.lit(sd) * F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def gamma_quantiles(shape: float, size: int = GAMMA_TABLE_SIZE) -> list[float]:
    """Quantiles of Gamma(shape, 1) where the tail holds exp(-GAMMA_TAIL * i / (size - 1)),
    by the series of the regularised lower incomplete gamma function on a fine grid."""
    x = np.linspace(0.0, 40.0, 40001)[1:]
    n = np.arange(0, 200)
    # P(a, x) = x^a e^-x / Gamma(a + 1) * sum_n x^n / ((a + 1) ... (a + n))
    log_terms = np.cumsum(np.log(x[:, None] / (shape + 1 + n[None, :-1])), axis=1)
    series = 1.0 + np.exp(log_terms).sum(axis=1)
    cdf = np.exp(shape * np.log(x) - x - math.lgamma(shape + 1)) * series
    cdf = np.minimum(np.maximum.accumulate(cdf), 1.0)
    probs = -np.expm1(-np.linspace(0.0, GAMMA_TAIL, size))
    q = np.interp(probs, np.concatenate([[0.0], cdf]), np.concatenate([[0.0], x]))
    return [float(v) for v in q]


def table_lookup(table: list[float], u: Column) -> Column:
    """Linear interpolation in an evenly spaced table at u in [0, 1]."""
    arr = F.array(*[F.lit(v) for v in table])
    pos = u * F.lit(len(table) - 1)
    i = F.floor(pos).cast("int")
    frac = pos - i
    lo = F.element_at(arr, i + 1)
    hi = F.element_at(arr, F.least(i + 2, F.lit(len(table))))
    return lo + (hi - lo) * frac


def gamma_draw(u: Column) -> Column:
    """The draw of Gamma(PRECIP_SHAPE, 1) at u in [0, 1)."""
    return table_lookup(_GAMMA, F.least(-F.log(F.lit(1.0) - u) / F.lit(GAMMA_TAIL), F.lit(1.0)))


def synthetic_inventory(sales: DataFrame, seed: int = 42, low_inventory_share: float = LOW_INVENTORY_SHARE) -> DataFrame:
    """One inventory row per sales row (H5); raw inventory contract."""
    require_columns(sales, ["store", "dept", "date", "weekly_sales"], "sales for inventory generation")
    key = [F.col("store"), F.col("dept"), F.col("date")]
    demand = F.greatest(F.coalesce(F.col("weekly_sales").try_cast("double"), F.lit(0.0)), F.lit(0.0))
    base = F.least(F.greatest(normal(COVERAGE_MEAN, COVERAGE_SD, seed, 1, *key), F.lit(COVERAGE_CLIP[0])),
                   F.lit(COVERAGE_CLIP[1]))
    low = uniform(seed, 3, *key) < F.lit(low_inventory_share)
    coverage = F.when(low, uniform_between(*LOW_COVERAGE, seed, 4, *key)).otherwise(base)
    safety = F.round(F.col("__demand") * uniform_between(*SAFETY_SHARE, seed, 5, *key), 2)
    reorder = F.round(F.col("safety_stock_units") + F.col("__demand") * uniform_between(*REORDER_SHARE, seed, 6, *key), 2)
    out = sales.select("store", "dept", F.col("date").try_cast("date").alias("date"), demand.alias("__demand"))
    return (
        out.withColumn("available_inventory", F.round(F.col("__demand") * coverage, 2))
        .withColumn("safety_stock_units", safety)
        .withColumn("reorder_point_units", reorder)
        .select(
            F.col("store").cast("int").alias("store"), F.col("dept").cast("int").alias("dept"), "date",
            sku("store", "dept").alias("sku"), "available_inventory", "safety_stock_units", "reorder_point_units",
        )
    )


_GAMMA = gamma_quantiles(PRECIP_SHAPE)


def synthetic_weather(features: DataFrame, seed: int = 42) -> DataFrame:
    """One weather row per feature row (H6); raw weather contract.

    Missing temperatures take the exact median temperature, found by a few
    counting passes over the column (``selection.exact_medians``).
    """
    require_columns(features, ["store", "date", "temperature"], "features for weather generation")
    key = [F.col("store"), F.col("date")]
    temp = F.col("temperature").try_cast("double")
    median = exact_medians(features.select(temp.alias("temperature")), ["temperature"])["temperature"]
    filled = F.coalesce(F.nanvl(temp, F.lit(None).cast("double")), F.lit(median).cast("double"))
    precip = F.round(
        F.least(F.greatest(F.lit(PRECIP_SCALE) * gamma_draw(uniform(seed, 11, *key)), F.lit(0.0)),
                F.lit(PRECIP_MAX)), 2)
    out = features.select("store", F.col("date").try_cast("date").alias("date"), filled.alias("temperature"),
                          precip.alias("precipitation"))
    snow = F.when(
        F.col("temperature") < SNOW_BELOW_TEMPERATURE,
        F.col("precipitation") * uniform_between(*SNOW_SHARE, seed, 12, F.col("store"), F.col("date")),
    ).otherwise(F.lit(0.0))
    return out.select(
        F.col("store").cast("int").alias("store"), "date", F.round("temperature", 2).alias("temperature"),
        "precipitation", F.round(snow, 2).alias("snowfall"),
    )
