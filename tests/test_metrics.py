"""Inventory from the properties that loads keep."""

import datetime as dt

from pyspark.sql import functions as F

from shelfcast.operators import quality
from shelfcast.sources import catalog, ledger, metrics


def frame(spark, *days):
    return spark.createDataFrame([(i, dt.date(2012, 1, d)) for i, d in enumerate(days)], "store int, date date")


def held(spark, table):
    p = metrics.properties(spark, table)
    return int(p[metrics.ROWS]), p.get(metrics.FIRST), p.get(metrics.LAST)


def test_loads_add_up_and_replace(spark):
    catalog.load(frame(spark, 6, 13), "m_raw", "sales", overwrite=True)
    assert held(spark, "m_raw.sales") == (2, "2012-01-06", "2012-01-13")
    created = metrics.properties(spark, "m_raw.sales")[metrics.CREATED]
    catalog.load(frame(spark, 20, 2), "m_raw", "sales")
    assert held(spark, "m_raw.sales") == (4, "2012-01-02", "2012-01-20")
    catalog.load(frame(spark, 9), "m_raw", "sales", overwrite=True)
    assert held(spark, "m_raw.sales") == (1, "2012-01-09", "2012-01-09")
    assert metrics.properties(spark, "m_raw.sales")[metrics.CREATED] == created
    catalog.load(spark.createDataFrame([], "store int, date date"), "m_raw", "sales", overwrite=True)
    assert held(spark, "m_raw.sales")[0] == 0
    schema = frame(spark, 1).schema
    for overwrite, rows in ((False, 2), (False, 4), (True, 2)):
        catalog.insert(frame(spark, 3, 4), "m_raw", "ins", schema, overwrite)
        assert held(spark, "m_raw.ins") == (rows, "2012-01-03", "2012-01-04")


def test_health_reads_no_data(spark):
    catalog.load(frame(spark, 6, 13), "m_health", "sales", overwrite=True)
    catalog.load(frame(spark, 6, 13).limit(0), "m_health", "inventory", overwrite=True)
    catalog.create_view(spark, "m_health", "some_view", "SELECT * FROM m_health.sales")
    inv = catalog.inventory(spark, {"raw": "m_health"})
    health = quality.pipeline_health(inv)
    assert "FileScan" not in health._jdf.queryExecution().executedPlan().toString()
    status = {r.object_name: (r.row_count, r.status) for r in health.collect()}
    assert status["RAW.SALES"] == (2, "Ready") and status["RAW.INVENTORY"] == (0, "Empty") and status["RAW.STORES"][1] == "Missing"
    kinds = {r.table_name: (r.table_type, r.row_count) for r in inv.collect()}
    assert kinds["SOME_VIEW"] == ("VIEW", 0)
    assert inv.where("table_type = 'BASE TABLE' and (created is null or last_altered is null)").count() == 0


def test_tables_of_others_are_counted_and_drift_is_seen(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS m_other")
    frame(spark, 6, 13, 20).write.mode("overwrite").saveAsTable("m_other.foreign_rows")
    catalog.load(frame(spark, 6), "m_other", "own", overwrite=True)
    assert {r.table_name: r.row_count for r in catalog.inventory(spark, {"raw": "m_other"}).collect()} == {"FOREIGN_ROWS": 3, "OWN": 1}
    catalog.load(frame(spark, 7), "m_other", "foreign_rows")  # still not known, so still counted
    assert metrics.ROWS not in metrics.properties(spark, "m_other.foreign_rows")
    drifted = {r.table_name: r.drifted for r in metrics.drift(spark, ["m_other.own"]).collect()}
    assert drifted == {"m_other.own": False}
    frame(spark, 27).write.insertInto("m_other.own")
    (row,) = metrics.drift(spark, ["m_other.own"]).collect()
    assert (row.recorded_rows, row.actual_rows, row.actual_last, row.drifted) == (1, 2, "2012-01-27", True)


def test_ledger_loads_are_recorded(spark, scratch):
    paths = []
    for i, days in enumerate(((6, 13), (20,))):
        paths.append(f"{scratch}/f{i}")
        frame(spark, *days).write.option("header", True).csv(paths[-1])
    schema = frame(spark, 1).schema

    def read(path):
        return spark.read.schema(schema).option("header", True).csv(path)

    spark.sql("DROP TABLE IF EXISTS m_raw.by_ledger")
    ledger.load_files(spark, "m_raw", "by_ledger", schema, paths[:1], read)
    assert held(spark, "m_raw.by_ledger") == (2, "2012-01-06", "2012-01-13")
    ledger.load_files(spark, "m_raw", "by_ledger", schema, paths, read)
    assert held(spark, "m_raw.by_ledger") == (3, "2012-01-06", "2012-01-20")
    ledger.load_files(spark, "m_raw", "by_ledger", schema, paths[1:], read, replace=True)
    assert held(spark, "m_raw.by_ledger") == (1, "2012-01-20", "2012-01-20")
    assert spark.table("m_raw.by_ledger").where(F.col("date").isNull()).count() == 0
