"""Properties of the synthetic inventory and weather generators."""

from pyspark.sql import functions as F

from shelfcast.operators.synth import PRECIP_SHAPE, gamma_draw, synthetic_inventory, synthetic_weather
from shelfcast.plans.warehouse import Warehouse

from conftest import SF_CHECK


def test_inventory_properties(spark):
    sales = Warehouse.from_testdata(spark, SF_CHECK).raw["sales"]
    inv = synthetic_inventory(sales)
    a = synthetic_inventory(sales.repartition(7)).exceptAll(inv.repartition(3)).count()
    assert a == 0  # same draws whatever the partitioning
    j = inv.join(sales.select("store", "dept", "date", "weekly_sales"), ["store", "dept", "date"])
    cov = F.col("available_inventory") / F.greatest("weekly_sales", F.lit(0.0))
    r = j.agg(F.count("*").alias("n"), F.min(cov).alias("lo"), F.max(cov).alias("hi"),
              F.avg((cov < 0.649).cast("int")).alias("low_share")).first()
    assert r["n"] == sales.count() == inv.count()
    assert 0.349 <= r["lo"] and r["hi"] <= 2.0501
    # 18 % of rows draw coverage from U(0.35, 0.95); half of those land below
    # the normal draw's clip floor of 0.65, so about 9 % of rows are below it.
    assert 0.07 <= r["low_share"] <= 0.11
    bad = inv.where((F.col("reorder_point_units") < F.col("safety_stock_units")) | (F.col("safety_stock_units") < 0))
    assert bad.count() == 0


def test_weather_properties(spark):
    feats = Warehouse.from_testdata(spark, SF_CHECK).raw["features"]
    w = synthetic_weather(feats)
    r = w.agg(F.count("*").alias("n"), F.min("precipitation").alias("lo"), F.max("precipitation").alias("hi"),
              F.count_if((F.col("snowfall") > 0) & (F.col("temperature") >= 35)).alias("warm_snow"),
              F.count_if(F.col("temperature").isNull()).alias("nulls")).first()
    assert r["n"] == feats.count() and r["lo"] >= 0 and r["hi"] <= 1.5
    assert r["warm_snow"] == 0 and r["nulls"] == 0


def test_gamma_quantiles(spark):
    from math import gamma

    import numpy as np

    n = 200_000
    x = np.sort(spark.range(n).select(gamma_draw(F.col("id") / F.lit(float(n))).alias("x")).toPandas().x.to_numpy())
    want = np.sort(np.random.default_rng(1).gamma(PRECIP_SHAPE, 1.0, 2_000_000))
    for p in (0.05, 0.25, 0.5, 0.9, 0.99, 0.999):
        assert abs(x[int(p * n)] / want[int(p * len(want))] - 1) < 0.05
    assert abs(x.mean() - PRECIP_SHAPE) < 0.01
    far = 12.5  # 1.0 inch of rain: a tail of about 4 / 400,000
    tail = far ** (PRECIP_SHAPE - 1) * np.exp(-far) / gamma(PRECIP_SHAPE)
    assert (x >= far).mean() < 3 * tail + 1e-5
