"""End-to-end refresh on landing files written from the small test tables."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import forest, kpis
from shelfcast.plans import refresh as R
from shelfcast.plans.warehouse import Warehouse
from shelfcast.sources.files import write_csv

from conftest import SF_SMALL

RUN_AT = dt.datetime(2024, 3, 1, 12, 0, 0)

# Landing headers as the source files spell them (loose on purpose).
HEADERS = {
    "sales": ["Store", "Dept", "Date", "Weekly Sales", "IsHoliday"],
    "stores": ["Store", "Type", "Size"],
    "features": ["Store", "Date", "Temperature", "FuelPrice", "MarkDown_1", "MarkDown_2", "MarkDown_3", "MarkDown_4",
                 "MarkDown_5", "CPI", "Unemployment", "Is_Holiday"],
    "inventory": ["Store", "Dept", "Date", "SKU", "Available_Inventory", "Safety_Stock_Units", "Reorder_Point_Units"],
}


def _write_landing(spark, landing):
    w = Warehouse.from_testdata(spark, SF_SMALL)
    counts = {}
    for name, headers in HEADERS.items():
        df = w.raw[name].drop("source_file", "loaded_at")
        write_csv(df.toDF(*headers), f"{landing}/{name}.csv")
        counts[name] = df.count()
    from shelfcast.operators.synth import synthetic_weather

    weather = synthetic_weather(w.raw["features"])
    write_csv(weather.toDF("Store", "Date", "Temperature", "Precipitation", "Snowfall"), f"{landing}/weather.csv")
    counts["weather"] = weather.count()
    return w, counts


def test_plan_steps_order():
    cfg = R.RefreshConfig(landing_dir="x", model_dir="y", source_dir="z")
    assert R.plan_steps(cfg) == ["prepare", "load_raw", "train", "score", "build_marts", "test_marts"]
    cfg = R.RefreshConfig(landing_dir="x", model_dir="y", skip_train=True, skip_tests=True)
    assert R.plan_steps(cfg) == ["load_raw", "score", "build_marts"]
    assert R.refresh(None, R.RefreshConfig("x", "y", dry_run=True)) == {"steps": ["load_raw", "train", "score",
                                                                             "build_marts", "test_marts"]}


def test_refresh_round_trip(spark, scratch):
    w, counts = _write_landing(spark, f"{scratch}/landing")
    cfg = R.RefreshConfig(
        landing_dir=f"{scratch}/landing", model_dir=f"{scratch}/model", run_at=RUN_AT, buckets=4,
        forest=forest.ForestParams(num_trees=4, max_depth=5),
    )
    res = R.refresh(spark, cfg)
    assert res["load_raw"] == counts
    groups = w.raw["sales"].select("store", "dept").distinct().count()
    assert res["score"]["demand_forecasts"] == counts["sales"] + groups
    assert res["score"]["sales_anomalies"] == counts["sales"]
    assert res["build_marts"]["fact_sales"] == counts["sales"]
    assert res["build_marts"]["fact_forecast"] == counts["sales"] + groups
    for family, rows in res["test_marts"].items():
        assert len(rows) > 0 and [r for r in rows if r["failing_rows"]] == [], family
    assert spark.table("raw.sales").where(F.col("loaded_at") != F.lit(RUN_AT)).count() == 0
    assert spark.table("raw.sales").select("source_file").distinct().count() >= 1

    # Reads over the refreshed catalog equal reads over the derived tables.
    cw = R.catalog_warehouse(spark)
    got = kpis.executive_metrics(cw.fact_sales, cw.fact_demand).first().asDict()
    want = kpis.executive_metrics(w.fact_sales, w.fact_demand).first().asDict()
    assert got == want
    # Facts bucketed by (store_id, dept_id): the (store, dept, date) join of
    # sales and demand shuffles neither side (only the distinct counts do).
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        df = kpis.executive_metrics(cw.fact_sales, cw.fact_demand)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    # The catalog inventory sees every expected object loaded.
    from shelfcast import api

    health = {r["object_name"]: r["status"] for r in api.pipeline_health(cw).collect()}
    assert set(health.values()) == {"Ready"} and len(health) == 20
    assert {r["status"] for r in api.quality_checks(cw).collect()} == {"Pass"}
    # The model reloads and scores.
    reloaded = forest.load(cfg.model_dir)
    assert reloaded.metrics["model_version"] == forest.model_version(RUN_AT)


def test_reads_fall_back_without_model_marts(spark):
    from shelfcast import api

    w = Warehouse.from_testdata(spark, SF_SMALL)
    bare = Warehouse(spark, w.raw, ml={})
    assert {r["model_version"] for r in api.forecast_results(bare).select("model_version").distinct().collect()} == {
        "phase_1_5"}
    assert api.stockout_risk_results(bare).select("model_version").distinct().first()[0] == "observed_demand_proxy"
    assert "severity" in api.anomaly_results(bare).columns
    assert api.forecast_filter_options(bare).where("horizon_days <> 0").count() == 0
    m = api.forecast_metrics(bare).first()
    assert m["forecast_rows"] == m["scored_rows"] == w.fact_sales.count()
    full = api.forecast_results(w)
    assert {r[0] for r in full.select("horizon_days").distinct().collect()} == {0, 7}
    assert len(api.READS) == 17
