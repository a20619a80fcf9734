"""Data quality checks, catalogue health and pipeline status.

I1-I3 (declared not-null, unique and relationship checks), G3 (row-count
report), I5-I7 and C7 (object inventory, expected objects, quality status),
D18-D20 (stage summary, pipeline KPIs, loaded-table counts).

Checks of one table are fused into one aggregation (one scan per table);
each check family is one DataFrame (a union of small aggregates), so a
report is one job.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared checks (table -> columns).
NOT_NULL = {
    "raw.sales": ("store", "dept", "date"),
    "raw.stores": ("store",),
    "raw.features": ("store", "date"),
    "raw.inventory": ("store", "dept", "date"),
    "ml.demand_forecasts": ("store", "dept", "forecast_date", "model_version"),
    "ml.stockout_risk": ("store", "dept", "risk_date", "risk_category"),
    "ml.sales_anomalies": ("store", "dept", "sales_date"),
    "staging.stg_sales": ("store_id", "dept_id", "sales_date"),
    "staging.stg_stores": ("store_id",),
    "staging.stg_inventory": ("store_id", "dept_id", "inventory_date"),
    "staging.int_sales_features": ("store_id", "dept_id", "sales_date"),
    "marts.dim_store": ("store_id",),
    "marts.dim_date": ("date_day",),
    "marts.fact_sales": ("store_id", "sales_date"),
    "marts.fact_inventory": ("store_id", "inventory_date"),
    "marts.fact_demand": ("store_id", "demand_date"),
    "marts.fact_forecast": ("store_id", "forecast_date", "predicted_demand", "model_version"),
    "marts.fact_stockout_risk": ("store_id", "risk_date", "risk_category"),
    "marts.fact_anomalies": ("store_id", "sales_date", "is_anomaly"),
}
UNIQUE = (
    ("raw.stores", "store"),
    ("staging.stg_stores", "store_id"),
    ("marts.dim_store", "store_id"),
    ("marts.dim_date", "date_day"),
)
# (child table, child column, parent table, parent column); fact_forecast has
# no date relationship: next-week dates are not in dim_date.
RELATIONSHIPS = (
    ("marts.fact_sales", "store_id", "marts.dim_store", "store_id"),
    ("marts.fact_sales", "sales_date", "marts.dim_date", "date_day"),
    ("marts.fact_inventory", "store_id", "marts.dim_store", "store_id"),
    ("marts.fact_inventory", "inventory_date", "marts.dim_date", "date_day"),
    ("marts.fact_demand", "store_id", "marts.dim_store", "store_id"),
    ("marts.fact_demand", "demand_date", "marts.dim_date", "date_day"),
    ("marts.fact_forecast", "store_id", "marts.dim_store", "store_id"),
    ("marts.fact_stockout_risk", "store_id", "marts.dim_store", "store_id"),
    ("marts.fact_anomalies", "store_id", "marts.dim_store", "store_id"),
)
ROW_COUNT_OBJECTS = (
    "raw.sales", "raw.inventory", "ml.demand_forecasts", "ml.stockout_risk", "ml.sales_anomalies",
    "marts.fact_forecast",
)

# Expected pipeline objects (schema, table, stage, description).
EXPECTED_OBJECTS = (
    ("RAW", "SALES", "Raw ingestion", "Weekly sales landing table"),
    ("RAW", "STORES", "Raw ingestion", "Store metadata landing table"),
    ("RAW", "FEATURES", "Raw ingestion", "Economic and holiday feature table"),
    ("RAW", "INVENTORY", "Raw ingestion", "Synthetic inventory landing table"),
    ("RAW", "WEATHER", "Raw ingestion", "Synthetic weather landing table"),
    ("STAGING", "STG_SALES", "dbt staging", "Typed sales staging view"),
    ("STAGING", "STG_STORES", "dbt staging", "Typed store staging view"),
    ("STAGING", "STG_FEATURES", "dbt staging", "Typed feature staging view"),
    ("STAGING", "STG_INVENTORY", "dbt staging", "Typed inventory staging view"),
    ("MARTS", "DIM_STORE", "dbt marts", "Store dimension"),
    ("MARTS", "DIM_DATE", "dbt marts", "Calendar dimension"),
    ("MARTS", "FACT_SALES", "dbt marts", "Sales fact table"),
    ("MARTS", "FACT_INVENTORY", "dbt marts", "Inventory fact table"),
    ("MARTS", "FACT_DEMAND", "dbt marts", "Demand and inventory fact table"),
    ("MARTS", "FACT_FORECAST", "Model marts", "Forecast fact table"),
    ("MARTS", "FACT_STOCKOUT_RISK", "Model marts", "Stockout risk fact table"),
    ("MARTS", "FACT_ANOMALIES", "Model marts", "Anomaly fact table"),
    ("ML", "DEMAND_FORECASTS", "ML outputs", "Forecast output table"),
    ("ML", "STOCKOUT_RISK", "ML outputs", "Stockout score output table"),
    ("ML", "SALES_ANOMALIES", "ML outputs", "Anomaly output table"),
)
STAGE_ORDER = {"Raw ingestion": 1, "dbt staging": 2, "dbt marts": 3, "ML outputs": 4, "Model marts": 5}

Tables = dict[str, DataFrame]  # "layer.table" -> DataFrame


def _status(failing: F.Column) -> F.Column:
    return F.when(failing == 0, F.lit("pass")).otherwise(F.lit("fail"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_null_report(tables: Tables, checks: dict[str, tuple[str, ...]] = NOT_NULL) -> DataFrame:
    """Failing rows per declared not-null column; one aggregation per table."""
    parts = []
    for name, cols in checks.items():
        if name not in tables:
            continue
        parts.append(tables[name].agg(F.array(*[
            F.struct(F.lit(name).alias("check_table"), F.lit(c).alias("check_column"),
                     F.count_if(F.col(c).isNull()).alias("failing_rows"))
            for c in cols
        ]).alias("checks")))
    s = F.explode("checks")
    out = _union(parts).select(s.alias("c")).select("c.*")
    return out.select("*", _status(F.col("failing_rows")).alias("status"))


def unique_report(tables: Tables, checks=UNIQUE) -> DataFrame:
    """Values occurring more than once per declared unique column; NULLs ignored."""
    parts = []
    for name, col in checks:
        if name not in tables:
            continue
        dup = tables[name].where(F.col(col).isNotNull()).groupBy(col).count().where(F.col("count") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).alias("failing_rows")).select(
            F.lit(name).alias("check_table"), F.lit(col).alias("check_column"), "failing_rows"))
    return _union(parts).withColumn("status", _status(F.col("failing_rows")))


def relationship_report(tables: Tables, checks=RELATIONSHIPS) -> DataFrame:
    """Child rows whose key is absent from the parent.

    The child's keys are counted first (partially in each task), so the left
    anti join is of key tables, not of facts."""
    parts = []
    for child, ccol, parent, pcol in checks:
        if child not in tables or parent not in tables:
            continue
        keys = tables[parent].select(F.col(pcol).alias("__k")).distinct()
        held = tables[child].where(F.col(ccol).isNotNull()).groupBy(F.col(ccol).alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
        orphans = held.join(keys, F.col("__c") == F.col("__k"), "left_anti")
        parts.append(orphans.agg(F.coalesce(F.sum("__n"), F.lit(0)).alias("failing_rows")).select(
            F.lit(child).alias("check_table"), F.lit(ccol).alias("check_column"),
            F.lit(f"{parent}.{pcol}").alias("parent_key"), "failing_rows"))
    return _union(parts).withColumn("status", _status(F.col("failing_rows")))


def row_count_report(tables: Tables, names=ROW_COUNT_OBJECTS) -> DataFrame:
    """UNION ALL of count(*) over the validation objects."""
    return _union([
        tables[n].agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n.upper()).alias("object_name"), "row_count")
        for n in names if n in tables
    ])


# --------------------------------------------------------------------------
# object inventory and pipeline health
# --------------------------------------------------------------------------
INVENTORY_SCHEMA = T.StructType([
    T.StructField("table_schema", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("table_type", T.StringType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("created", T.TimestampNTZType()),
    T.StructField("last_altered", T.TimestampNTZType()),
])


def tables_inventory(spark: SparkSession, tables: Tables, views: set[str], stamp: _dt.datetime | None) -> DataFrame:
    """Inventory rows for a set of frames: base tables counted in one job,
    views reported with 0 rows (I5 over an in-memory warehouse)."""
    parts = []
    for name, df in tables.items():
        db, t = name.split(".")
        is_view = name in views
        ts = F.lit(None).cast("timestamp_ntz") if (is_view or stamp is None) else F.lit(stamp).cast("timestamp_ntz")
        cols = [F.lit(db.upper()).alias("table_schema"), F.lit(t.upper()).alias("table_name"),
                F.lit("VIEW" if is_view else "BASE TABLE").alias("table_type")]
        if is_view:
            parts.append(spark.range(1).select(*cols, F.lit(0).cast("bigint").alias("row_count"),
                                               ts.alias("created"), ts.alias("last_altered")))
        else:
            parts.append(df.agg(*cols, F.count(F.lit(1)).alias("row_count"), ts.alias("created"),
                                ts.alias("last_altered")))
    return _union(parts)


def platform_summary(inventory: DataFrame) -> DataFrame:
    """Objects of the four layers, ordered."""
    return inventory.where(F.col("table_schema").isin("RAW", "STAGING", "MARTS", "ML")).orderBy(
        "table_schema", "table_name")


def expected_objects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(*o, STAGE_ORDER[o[2]]) for o in EXPECTED_OBJECTS],
        "table_schema string, table_name string, pipeline_stage string, description string, stage_order int",
    )


def pipeline_health(inventory: DataFrame) -> DataFrame:
    """Expected objects LEFT the inventory: Missing / Empty / Ready."""
    e = F.broadcast(expected_objects(inventory.sparkSession))
    i = inventory.select(*[F.col(c).alias(f"i_{c}") for c in inventory.columns])
    j = e.join(i, (e.table_schema == i.i_table_schema) & (e.table_name == i.i_table_name), "left")
    status = (
        F.when(F.col("i_table_name").isNull(), "Missing")
        .when((F.col("i_table_type") == "BASE TABLE") & (F.coalesce("i_row_count", F.lit(0)) == 0), "Empty")
        .otherwise("Ready")
    )
    return j.select(
        "pipeline_stage", "table_schema", "table_name",
        F.concat_ws(".", "table_schema", "table_name").alias("object_name"), "description",
        F.coalesce("i_table_type", F.lit("MISSING")).alias("object_type"),
        F.coalesce("i_row_count", F.lit(0)).cast("bigint").alias("row_count"),
        F.col("i_created").alias("created"), F.col("i_last_altered").alias("last_altered"),
        status.alias("status"), "stage_order",
    ).orderBy("stage_order", "table_schema", "table_name").drop("stage_order")


def quality_status(inventory: DataFrame) -> DataFrame:
    """Base table with rows or view: Pass; else Review; RAW, MARTS, ML."""
    inv = inventory.where(F.col("table_schema").isin("RAW", "MARTS", "ML"))
    status = F.when((F.col("table_type") == "BASE TABLE") & (F.col("row_count") > 0), "Pass").when(
        F.col("table_type") == "VIEW", "Pass").otherwise("Review")
    return inv.select(
        F.concat_ws(".", "table_schema", "table_name").alias("object_name"), "table_type", "row_count",
        status.alias("status"), "last_altered", "table_schema", "table_name",
    ).orderBy("table_schema", "table_name").drop("table_schema", "table_name")


def layer_summary(health: DataFrame) -> DataFrame:
    """Per stage: objects, ready, to review, rows, newest change; label."""
    g = health.groupBy("pipeline_stage").agg(
        F.count("object_name").alias("total_objects"),
        F.count_if(F.col("status") == "Ready").alias("ready_objects"),
        F.count_if(F.col("status") != "Ready").alias("review_objects"),
        F.sum("row_count").cast("bigint").alias("row_count"),
        F.max("last_altered").alias("last_altered"),
    )
    order = F.coalesce(*[F.when(F.col("pipeline_stage") == k, F.lit(v)) for k, v in STAGE_ORDER.items()], F.lit(99))
    label = F.when(F.col("review_objects") == 0, F.lit("Ready")).otherwise(
        F.concat(F.col("review_objects").cast("string"), F.lit(" to review")))
    return g.select("*", label.alias("stage_status"), order.alias("__o")).orderBy("__o").drop("__o")


def stage_statuses(summary: DataFrame) -> DataFrame:
    """A label for every stage, in order; "Not found" for one without objects."""
    stages = summary.sparkSession.createDataFrame([(k, v) for k, v in STAGE_ORDER.items()], "stage string, stage_order int")
    found = summary.select(F.col("pipeline_stage").alias("stage"), "stage_status")
    return stages.join(found, "stage", "left").select(
        F.col("stage").alias("pipeline_stage"), F.coalesce("stage_status", F.lit("Not found")).alias("stage_status"), "stage_order",
    ).orderBy("stage_order")


def rows_by_layer(summary: DataFrame) -> DataFrame:
    """Stages with rows, for the chart."""
    return summary.where(F.col("row_count") > 0).select("pipeline_stage", "row_count")


def pipeline_kpis(health: DataFrame) -> DataFrame:
    """Latest refresh, ready / review / total objects, base tables, rows."""
    return health.agg(
        F.max("last_altered").alias("latest_refresh"),
        F.count_if(F.col("status") == "Ready").alias("ready_objects"),
        F.count_if(F.col("status") != "Ready").alias("review_objects"),
        F.count(F.lit(1)).alias("expected_objects"),
        F.count_if(F.col("object_type") == "BASE TABLE").alias("base_tables"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("warehouse_rows"),
    )


def loaded_table_counts(inventory: DataFrame, quality: DataFrame) -> DataFrame:
    """Distinct tables per layer (all, and with rows), passing / review checks."""
    def distinct_where(cond: F.Column) -> F.Column:
        return F.count_distinct(F.when(cond, F.col("table_name")))

    s, rows = F.col("table_schema"), F.col("row_count") > 0
    inv = inventory.agg(
        distinct_where(s == "RAW").alias("raw_objects"),
        distinct_where(s == "MARTS").alias("mart_objects"),
        distinct_where(s == "ML").alias("ml_objects"),
        distinct_where((s == "RAW") & rows).alias("raw_loaded"),
        distinct_where((s == "MARTS") & rows).alias("mart_loaded"),
    )
    q = quality.agg(F.count_if(F.col("status") == "Pass").alias("checks_passing"),
                    F.count_if(F.col("status") != "Pass").alias("open_reviews"))
    return inv.select("*", q.select("checks_passing").scalar().alias("checks_passing"),
                      q.select("open_reviews").scalar().alias("open_reviews"))
