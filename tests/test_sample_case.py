"""The 8-row hand-checked sample: every read agrees with the worked values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.contracts import RAW_CONTRACTS
from shelfcast.operators import features, forecast_reads as fr, kpis, scoring
from shelfcast.plans.warehouse import Warehouse

D1, D2 = dt.date(2012, 1, 6), dt.date(2012, 1, 13)
TS = dt.datetime(2024, 1, 1)
# The sample sales and inventory rows (store, dept, date, sales, inventory).
SAMPLE = [
    (1, 1, D1, 24924.50, 52000.0), (1, 1, D2, 46039.49, 48000.0),
    (1, 2, D1, 50605.27, 54000.0), (1, 2, D2, 44682.74, 43000.0),
    (2, 1, D1, 18542.20, 30000.0), (2, 1, D2, 19735.42, 22000.0),
    (2, 2, D1, 61234.88, 65000.0), (2, 2, D2, 59012.10, 51000.0),
]
SCORES = [(0.4793, "Low"), (0.9592, "High"), (0.9371, "High"), (1.0391, "High"),
          (0.6181, "Medium"), (0.8971, "Medium"), (0.9421, "High"), (1.1571, "Critical")]


@pytest.fixture(scope="module")
def wh(spark):
    sales = spark.createDataFrame([(s, d, t, v, False, "sales.csv", TS) for s, d, t, v, _ in SAMPLE],
                                  RAW_CONTRACTS["sales"].table_schema)
    inv = spark.createDataFrame([(s, d, t, f"SKU-{s}-{d}", i, 0.0, 0.0, "inventory.csv", TS) for s, d, t, _, i in SAMPLE],
                                RAW_CONTRACTS["inventory"].table_schema)
    stores = spark.createDataFrame([(1, "A", 151315, "stores.csv", TS), (2, "A", 202307, "stores.csv", TS)],
                                   RAW_CONTRACTS["stores"].table_schema)
    feats = spark.createDataFrame(
        [(s, t, 40.0, 3.1, 1.0, 2.0, 0.0, 1.0, 1.0, 211.0, 8.1, False, "features.csv", TS) for s in (1, 2) for t in (D1, D2)],
        RAW_CONTRACTS["features"].table_schema)
    return Warehouse(spark, {"sales": sales, "inventory": inv, "stores": stores, "features": feats})


def test_executive_metrics(wh):
    r = kpis.executive_metrics(wh.fact_sales, wh.fact_demand).first()
    assert round(r["total_sales"], 2) == 324776.60 and r["sales_records"] == 8
    assert (r["store_count"], r["dept_count"], r["start_date"], r["end_date"]) == (2, 2, D1, D2)
    assert r["high_or_critical_risk_count"] == 5


def test_sales_trend(wh):
    got = [round(r["weekly_sales"], 2) for r in kpis.sales_trend(wh.fact_sales).collect()]
    assert got == [155306.85, 169469.75]


def test_stockout_scores(wh):
    rows = scoring.demand_detail(wh.fact_demand).collect()
    assert [(round(r["stockout_risk_score"], 4), r["risk_category"]) for r in rows] == [
        SCORES[i] for i in (0, 2, 4, 6, 1, 3, 5, 7)]


def test_lag_forecast(wh):
    m = fr.baseline_metrics(wh.fact_sales).first()
    assert round(m["predicted_demand"], 2) == 317695.15 and round(m["wape"], 6) == 0.140651
    base = fr.baseline_forecast(wh.fact_sales).where(F.col("sales_date") == D2).orderBy("store_id", "dept_id")
    assert [r["baseline_forecast"] for r in base.collect()] == [24924.50, 50605.27, 18542.20, 61234.88]


def test_zscores(wh):
    rows = scoring.sales_anomaly_output(wh.stg_sales).collect()
    assert sorted({r["anomaly_score"] for r in rows}) == [-1.0, 1.0]
    assert not any(r["is_anomaly"] for r in rows)


def test_dims_split_next_week(wh):
    assert wh.dim_store.count() == 2 and wh.dim_date.count() == 2
    frame = features.training_frame(wh.raw["sales"], wh.raw["stores"], wh.raw["features"])
    sp = features.chronological_split(frame, 0.2)
    assert (sp.train_rows, sp.test_rows, sp.train.count(), sp.test.count()) == (8, 8, 8, 8)
    nxt = features.next_week_rows(frame).collect()
    assert len(nxt) == 4 and {r["date"] for r in nxt} == {dt.date(2012, 1, 20)}
    assert {r["week_of_year"] for r in nxt} == {3}
