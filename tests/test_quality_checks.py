"""Seeded faults are found by the declared checks."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import quality
from shelfcast.plans.warehouse import Warehouse

from conftest import SF_SMALL


def _failing(report):
    return {(r["check_table"], r["check_column"]): r["failing_rows"] for r in report.collect() if r["failing_rows"]}


def test_clean_tables_pass(spark):
    t = Warehouse.from_testdata(spark, SF_SMALL).layer_tables()
    assert _failing(quality.not_null_report(t)) == {}
    assert _failing(quality.unique_report(t)) == {}
    assert _failing(quality.relationship_report(t)) == {}


def test_seeded_faults(spark):
    w = Warehouse.from_testdata(spark, SF_SMALL)
    t = w.layer_tables()
    # duplicate store, NULL key, orphan store in the sales fact
    t["raw.stores"] = t["raw.stores"].unionByName(t["raw.stores"].limit(1))
    t["marts.fact_sales"] = t["marts.fact_sales"].unionByName(
        t["marts.fact_sales"].limit(2).withColumn("store_id", F.lit(999))
    ).unionByName(t["marts.fact_sales"].limit(3).withColumn("sales_date", F.lit(None).cast("date")))
    assert _failing(quality.unique_report(t)) == {("raw.stores", "store"): 1}
    assert _failing(quality.not_null_report(t)) == {("marts.fact_sales", "sales_date"): 3}
    assert _failing(quality.relationship_report(t)) == {("marts.fact_sales", "store_id"): 2}


def test_health_statuses(spark):
    inv = spark.createDataFrame(
        [("RAW", "SALES", "BASE TABLE", 10, None, dt.datetime(2024, 1, 1)),
         ("RAW", "STORES", "BASE TABLE", 0, None, None),
         ("STAGING", "STG_SALES", "VIEW", 0, None, None)],
        quality.INVENTORY_SCHEMA)
    h = {r["object_name"]: r["status"] for r in quality.pipeline_health(inv).collect()}
    assert h["RAW.SALES"] == "Ready" and h["RAW.STORES"] == "Empty" and h["STAGING.STG_SALES"] == "Ready"
    assert h["RAW.WEATHER"] == "Missing" and len(h) == 20
    q = {r["object_name"]: r["status"] for r in quality.quality_status(inv).collect()}
    assert q == {"RAW.SALES": "Pass", "RAW.STORES": "Review"}
    layers = {r["pipeline_stage"]: r["stage_status"] for r in quality.layer_summary(quality.pipeline_health(inv)).collect()}
    assert layers["Raw ingestion"] == "4 to review" and layers["dbt staging"] == "3 to review"
