"""Stored layers: pruned scans, pushed filters, known sizes, renewal."""

import re

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import features, forecast_reads, kpis, quality
from shelfcast.plans.groups import attach_group_stats
from shelfcast.plans.joins import estimated_bytes
from shelfcast.plans.warehouse import Warehouse
from shelfcast.session import file_listing, store_layer

from conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df) -> list[str]:
    return [line for line in plan(df).splitlines() if "FileScan parquet" in line]


@pytest.fixture(scope="module")
def shared(spark):
    return Warehouse.shared(spark, SF_SMALL)


def test_scans_are_pruned_and_filtered(spark, shared):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    df = shared.fact_sales.where("sales_date >= date'1996-01-01' and store_id = 3").agg(F.sum("weekly_sales"))
    (scan,) = scans(df)
    assert "stored_layers" in scan and "is_holiday" not in scan.split("ReadSchema")[1]
    assert "EqualTo(store_id,3)" in scan and "GreaterThanOrEqual(sales_date,1996-01-01)" in scan
    assert not re.search(r"Scan ExistingRDD", plan(shared.fact_demand))


def test_group_statistics_are_broadcast_by_their_known_size(spark):
    facts = store_layer(spark.range(400_000).select(
        (F.col("id") % 20).cast("int").alias("store_id"), (F.col("id") % 7).cast("int").alias("dept_id"),
        F.rand(1).alias("weekly_sales"), *[F.rand(i).alias(f"x{i}") for i in range(30)]))
    groups = facts.groupBy("store_id", "dept_id").agg(F.avg("weekly_sales").alias("m"))
    assert estimated_bytes(groups) < 20_000 < estimated_bytes(facts)
    joined = attach_group_stats(facts, ["store_id", "dept_id"], {"m": F.avg("weekly_sales")})
    assert "BroadcastHashJoin" in plan(joined) and "SortMergeJoin" not in plan(joined)


def test_baseline_and_next_week_broadcast_their_group_tables(shared):
    assert "SortMergeJoin" not in plan(forecast_reads.baseline_forecast(shared.fact_sales))
    raw = shared.raw
    text = plan(features.next_week_from(raw["sales"], raw["stores"], raw["features"]))
    assert re.search(r"BroadcastHashJoin .*LeftSemi", text)


def test_totals_expand_groups_not_rows(shared):
    for df in (kpis.sales_totals(shared.fact_sales), kpis.executive_metrics(shared.fact_sales, shared.fact_demand)):
        text = plan(df).split("Initial Plan")[-1]
        expand, group = text.index("Expand"), text.index("keys=[store_id")
        assert expand < text.rindex("keys=[store_id") and group >= 0  # the expansion stands above the grouping


def test_relationships_join_key_tables(shared):
    report = quality.relationship_report(shared.layer_tables())
    text = plan(report)
    anti = [line for line in text.splitlines() if "LeftAnti" in line]
    # Of facts only where the parent's keys are broadcast; else of counted keys.
    assert anti and all("BroadcastHashJoin" in line or "__c" in line for line in anti)
    assert not re.search(r"SortMergeJoin", text)


def test_layers_are_renewed_when_files_change(spark, scratch):
    folder = f"{scratch}/tables"
    for name in ("lineitem", "supplier", "part", "nation", "orders", "customer"):
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    first = Warehouse.shared(spark, folder)
    assert Warehouse.shared(spark, folder) is first and len(file_listing(spark, folder)) >= 6
    n = first.fact_sales.count()
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(500).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    again = Warehouse.shared(spark, folder)
    assert again is not first and again.fact_sales.count() < n
