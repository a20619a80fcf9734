"""Catalog tables and views: raw, staging, marts and ml layers.

A5 (append / overwrite loads with row counts from ``observe``), A7 (ensure
table from a contract), A8 (typed insert), A12 (scan by logical name), A13
(object-exists switch), A14 (views for staging, tables for marts), I5 (the
catalog inventory).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import metrics

RAW, STAGING, MARTS, ML = "raw", "staging", "marts", "ml"
LAYERS = (RAW, STAGING, MARTS, ML)
MART_TABLES = (
    "dim_store", "dim_date", "fact_sales", "fact_inventory", "fact_demand", "fact_forecast", "fact_stockout_risk",
    "fact_anomalies",
)


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


def object_exists(spark: SparkSession, db: str, name: str) -> bool:
    """Whether a table or view exists (A13); no job runs."""
    return spark.catalog.tableExists(f"{db}.{name}")


def table(spark: SparkSession, db: str, name: str) -> DataFrame:
    """Scan a table by its logical name."""
    return spark.table(f"{db}.{name}")


def ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)


def ensure_table(spark: SparkSession, db: str, name: str, schema: T.StructType) -> None:
    """Create the table with the contract's columns when it is absent (A7);
    an existing table must carry every contract column."""
    ensure_database(spark, db)
    if object_exists(spark, db, name):
        have = set(spark.table(f"{db}.{name}").columns)
        missing = [f.name for f in schema.fields if f.name not in have]
        if missing:
            raise ValueError(f"{db}.{name} lacks contract columns: {', '.join(missing)}")
        return
    spark.sql(f"CREATE TABLE IF NOT EXISTS {db}.{name} ({ddl(schema)}) USING parquet {metrics.EMPTY}")


def load(df: DataFrame, db: str, name: str, overwrite: bool = False,
         buckets: tuple[int, tuple[str, ...], str] | None = None) -> int:
    """Append (or replace) rows of ``db.name``; returns the rows written (A5).
    ``buckets``: their number, their columns, and the order within.

    The count and the date bounds are an ``Observation`` collected by the
    write job itself, not a second pass over the data, and become the table's
    properties (``sources.metrics``).
    """
    spark, table_name = df.sparkSession, f"{db}.{name}"
    ensure_database(spark, db)
    existed = object_exists(spark, db, name)
    kept = metrics.properties(spark, table_name) if existed else {}
    obs = Observation(f"load_{db}_{name}")
    counted = metrics.observed(df, obs)
    writer = counted.write.mode("overwrite" if overwrite else "append").format("parquet")
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1]).sortBy(buckets[2])
    writer.saveAsTable(table_name)
    if overwrite and metrics.CREATED in kept:  # replacing makes a new table
        spark.sql(f"ALTER TABLE {table_name} SET TBLPROPERTIES ('{metrics.CREATED}' = '{kept[metrics.CREATED]}')")
    return metrics.record_observed(spark, table_name, obs, overwrite or not existed)


def insert(df: DataFrame, db: str, name: str, schema: T.StructType, overwrite: bool = False) -> int:
    """Ensure, then insert by position in contract order."""
    ensure_table(df.sparkSession, db, name, schema)
    obs = Observation(f"insert_{db}_{name}")
    ordered = metrics.observed(df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]), obs)
    ordered.write.insertInto(f"{db}.{name}", overwrite=overwrite)
    return metrics.record_observed(df.sparkSession, f"{db}.{name}", obs, overwrite)


def create_view(spark: SparkSession, db: str, name: str, sql: str) -> None:
    """Persistent view (staging layer, A14)."""
    ensure_database(spark, db)
    spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} AS {sql}")


def materialise(df: DataFrame, db: str, name: str) -> int:
    """Full rebuild of a mart table."""
    return load(df, db, name, overwrite=True)


def inventory(spark: SparkSession, databases: dict[str, str] | None = None) -> DataFrame:
    """Catalog inventory: schema, table, type, row_count, created,
    last_altered (I5).

    Rows and times of a base table are the properties that its loads keep;
    only tables without them (written by something else) are counted, with
    their data files' times.  Views count 0, as in the reference.
    ``databases``: layer -> database, where they aren't named alike.
    """
    databases = databases or {layer: layer for layer in LAYERS}
    known, uncounted = [], []
    for layer, db in databases.items():
        if not spark.catalog.databaseExists(db):
            continue
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            names = (layer.upper(), t.name.upper(), "VIEW" if t.tableType == "VIEW" else "BASE TABLE")
            held = {} if t.tableType == "VIEW" else metrics.properties(spark, f"{db}.{t.name}")
            if t.tableType != "VIEW" and metrics.ROWS not in held:
                uncounted.append((names, f"{db}.{t.name}"))
            else:
                known.append((*names, int(held.get(metrics.ROWS, 0)), held.get(metrics.CREATED), held.get(metrics.ALTERED)))
    rows = spark.createDataFrame(
        known, "table_schema string, table_name string, table_type string, row_count long, created string, last_altered string")
    out = rows.select("table_schema", "table_name", "table_type", "row_count", F.col("created").cast("timestamp_ntz"),
                      F.col("last_altered").cast("timestamp_ntz"))
    for names, table_name in uncounted:
        files = spark.table(table_name).select(F.col("_metadata.file_modification_time").alias("m"))
        out = out.unionByName(files.agg(
            *[F.lit(v).alias(c) for v, c in zip(names, ("table_schema", "table_name", "table_type"), strict=True)],
            F.count(F.lit(1)).alias("row_count"), F.min("m").cast("timestamp_ntz").alias("created"),
            F.max("m").cast("timestamp_ntz").alias("last_altered")))
    return out.orderBy("table_schema", "table_name")
