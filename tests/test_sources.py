"""File sources and sinks: contract reads, validation, prepare, staging, streaming loads."""

import pytest
from pyspark.sql import functions as F

from shelfcast.contracts import RAW_CONTRACTS, MissingColumnsError
from shelfcast.operators.prepare import prepare
from shelfcast.sources import catalog
from shelfcast.sources.adapter import dirty_features_source, dirty_sales_source
from shelfcast.sources.files import MissingSourceError, contract_read, stage_entities, validate_sources, write_csv
from shelfcast.streaming.landing import load_new_files

from conftest import SF_SMALL


def test_contract_read_types_and_stamps(spark, scratch):
    write_csv(dirty_sales_source(spark, SF_SMALL), f"{scratch}/sales.csv")
    df = contract_read(spark, f"{scratch}/sales.csv", RAW_CONTRACTS["sales"])
    assert df.columns == RAW_CONTRACTS["sales"].table_schema.names
    assert [f.dataType.simpleString() for f in df.schema.fields][:5] == ["int", "int", "date", "double", "boolean"]
    r = df.agg(F.count("*").alias("n"), F.count_if(F.col("weekly_sales").isNull()).alias("na"),
               F.count_if(F.col("date").isNull()).alias("bad"), F.count_if(F.col("source_file").isNull()).alias("nf"),
               F.count_if(F.col("loaded_at").isNull()).alias("nl")).first()
    assert r["na"] > 0 and r["bad"] > 0 and r["nf"] == 0 and r["nl"] == 0


def test_missing_sources_raise_before_loading(spark, scratch):
    with pytest.raises(MissingSourceError):
        validate_sources(spark, scratch, ["sales"])
    with pytest.raises(ValueError):
        validate_sources(spark, scratch, ["orders"])
    spark.createDataFrame([("1", "2")], "Store string, Dept string").write.option("header", True).csv(
        f"{scratch}/sales.csv")
    with pytest.raises(MissingColumnsError):
        contract_read(spark, f"{scratch}/sales.csv", RAW_CONTRACTS["sales"])


def test_load_append_and_overwrite(spark, scratch):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert catalog.load(df, "raw", "t_load", overwrite=True) == 1
    assert catalog.load(df, "raw", "t_load") == 1
    assert spark.table("raw.t_load").count() == 2
    assert catalog.load(df, "raw", "t_load", overwrite=True) == 1
    assert catalog.object_exists(spark, "raw", "t_load") and not catalog.object_exists(spark, "raw", "nope")


def test_prepare_from_source_files(spark, scratch):
    src = f"{scratch}/src"
    write_csv(dirty_sales_source(spark, SF_SMALL), f"{src}/train.csv")
    write_csv(dirty_features_source(spark, SF_SMALL), f"{src}/features.csv")
    write_csv(spark.read.parquet(f"{SF_SMALL}/nation.parquet").selectExpr(
        "n_nationkey as Store", "'A' as Type", "100000 as Size"), f"{src}/stores.csv")
    out = prepare(spark, src, f"{scratch}/landing", include_synthetic=True)
    assert set(out) == {"sales", "stores", "features", "inventory", "weather"}
    sales = contract_read(spark, out["sales"], RAW_CONTRACTS["sales"])
    inv = contract_read(spark, out["inventory"], RAW_CONTRACTS["inventory"])
    assert sales.count() == inv.count() == dirty_sales_source(spark, SF_SMALL).count()
    feats = contract_read(spark, out["features"], RAW_CONTRACTS["features"])
    assert feats.where(F.col("markdown5") != 0).count() == 0 and feats.where(F.col("markdown1").isNull()).count() == 0


def test_stage_entities(spark, scratch):
    frames = {"sales": spark.createDataFrame([(1,)], "Store int")}
    paths = stage_entities(frames, f"file://{scratch}/bucket/prefix")
    assert spark.read.option("header", True).csv(paths["sales"]).count() == 1


def test_streaming_appends_each_file_once(spark, scratch):
    landing, table = f"{scratch}/landing", f"{scratch}/raw_sales"
    rows = [("1", "1", "2012-01-06", "10.5", "false"), ("1", "2", "bad", "NA", "yes")]
    header = ["Store", "Dept", "Date", "Weekly_Sales", "IsHoliday"]
    spark.createDataFrame(rows, header).coalesce(1).write.option("header", True).csv(f"{landing}/sales/day1")
    load_new_files(spark, landing, "sales", table, f"{scratch}/ckpt")
    assert spark.read.parquet(table).count() == 2
    spark.createDataFrame(rows[:1], header).coalesce(1).write.option("header", True).csv(f"{landing}/sales/day2")
    load_new_files(spark, landing, "sales", table, f"{scratch}/ckpt")
    load_new_files(spark, landing, "sales", table, f"{scratch}/ckpt")  # nothing new: no duplicates
    got = spark.read.parquet(table)
    assert got.count() == 3
    assert got.where(F.col("date").isNull() & F.col("weekly_sales").isNull() & F.col("is_holiday")).count() == 1
    assert got.select("source_file").distinct().count() == 2


def test_output_files_round_trip(spark, scratch):
    from shelfcast.plans.refresh import load_outputs
    from shelfcast.plans.warehouse import Warehouse
    from shelfcast.sources.files import lower_columns, read_canonical, write_outputs

    w = Warehouse.from_testdata(spark, SF_SMALL)
    frames = {name: df.toDF(*[c.title() for c in df.columns]) for name, df in w.ml.items()}
    paths = write_outputs(frames, f"{scratch}/ml_outputs")
    counts = load_outputs(spark, f"{scratch}/ml_outputs")
    assert counts == {name: df.count() for name, df in w.ml.items()}
    back = spark.table("ml.demand_forecasts")
    assert back.where("horizon_days = 7").count() == w.ml["demand_forecasts"].where("horizon_days = 7").count()
    assert back.where(F.col("created_at").isNull()).count() == 0
    assert lower_columns(frames["sales_anomalies"]).columns == list(w.ml["sales_anomalies"].columns)
    assert len(paths) == 3

    for name in ("sales", "stores", "features"):
        df = w.raw[name].drop("source_file", "loaded_at")
        write_csv(df, f"{scratch}/landing/{RAW_CONTRACTS[name].file_name}")
    sales, stores, feats = read_canonical(spark, f"{scratch}/landing")
    assert (sales.count(), stores.count(), feats.count()) == tuple(w.raw[n].count() for n in ("sales", "stores", "features"))


def test_small_side_broadcasts_only_under_the_bound(spark):
    from shelfcast.plans.joins import estimated_bytes, small_side

    small = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    big = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    assert estimated_bytes(small) is not None
    assert "broadcast" in small_side(small)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in small_side(big, limit_bytes=1024)._jdf.queryExecution().analyzed().toString().lower()


def test_ensure_table_checks_existing_columns(spark):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    catalog.ensure_table(spark, "ml", "t_ensure", schema)
    catalog.ensure_table(spark, "ml", "t_ensure", schema)  # idempotent
    assert spark.table("ml.t_ensure").columns == ["a", "b"]
    wider = T.StructType([*schema.fields, T.StructField("c", T.DoubleType())])
    with pytest.raises(ValueError):
        catalog.ensure_table(spark, "ml", "t_ensure", wider)
