"""Registered queries that go through files and catalog tables.

Sources and sinks are exercised on the test tables' own data: rows are
written as the landing files or tables a user would have, below the shared
checkpoint folder or in the session catalog, read back through the engine's
readers, and compared with the rows they came from.  What was written is kept
for the warehouse's later queries.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ML_CONTRACTS, RAW_CONTRACTS, coerce
from ..functions.scalar import local_time_text, sku
from ..operators import forecast_reads as fr
from ..operators import marts, quality, scoring, staging
from ..session import checkpoint_dir
from ..sources import catalog, metrics
from ..sources.files import contract_read, lower_columns, read_canonical, validate_sources, write_csv, write_outputs
from .oracle import msum, wape_sql
from .registry import _HEALTH, _INV, register
from .warehouse import Warehouse


def _once(w: Warehouse, name: str, make: Callable[[], object]):
    """What ``make`` wrote for this warehouse, made on first use."""
    held = w.__dict__.setdefault("_written", {})
    if name not in held:
        held[name] = make()
    return held[name]


def _folder(w: Warehouse, name: str) -> str:
    return f"{checkpoint_dir(w.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# -- landing files (A1-A4, A9, B2, B4, I4) -----------------------------------------
_SOURCE_HEADERS = {"sales": ("Store", "DEPT", "date", "Weekly Sales", "Is_Holiday"), "stores": ("store", "Type", "Size")}


def _landing(w: Warehouse) -> str:
    """The raw tables as landing CSV files, two of them with other spellings of their headers."""
    base = _folder(w, "landing")
    for name, contract in RAW_CONTRACTS.items():
        rows = (w.raw_weather if name == "weather" else w.raw[name]).select(*contract.names)
        write_csv(rows.toDF(*_SOURCE_HEADERS.get(name, contract.names)), f"{base}/{contract.file_name}")
    return base


def _landed(name: str) -> Callable[[Warehouse], DataFrame]:
    def read(w: Warehouse) -> DataFrame:
        base = _once(w, "landing", lambda: _landing(w))
        path = validate_sources(w.spark, base, [name])[name]
        return contract_read(w.spark, path, RAW_CONTRACTS[name]).select(*RAW_CONTRACTS[name].names)

    return read


for _name in ("sales", "stores", "features", "inventory"):
    _columns = ", ".join(RAW_CONTRACTS[_name].names)
    register(f"landing_{_name}", f"select {_columns} from raw_{_name}", f"raw_{_name}")(_landed(_name))


@register("canonical_rows", """
select 'sales' entity, count(*) n, min(date) first_date, max(date) last_date from raw_sales
union all select 'stores', count(*), null, null from raw_stores
union all select 'features', count(*), min(date), max(date) from raw_features""", "raw_sales", "raw_stores", "raw_features")
def _canonical_rows(w: Warehouse) -> DataFrame:
    frames = read_canonical(w.spark, _once(w, "landing", lambda: _landing(w)))
    parts = []
    for entity, df in zip(("sales", "stores", "features"), frames, strict=True):
        date = F.col("date") if "date" in df.columns else F.lit(None).cast("date")
        counts = df.agg(F.count(F.lit(1)).alias("n"), F.min(date).alias("first_date"), F.max(date).alias("last_date"))
        parts.append(counts.select(F.lit(entity).alias("entity"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -- tables: load, ensure, insert, scan, materialise (A5-A8, A10, A12-A14) ------------
def _table(w: Warehouse, name: str) -> str:
    return f"{name}_{w.spark.sparkContext.applicationId.replace('-', '_')}_{uuid.uuid4().hex[:8]}"


@register("loaded_table", "select store, dept, date, weekly_sales, is_holiday from raw_sales", "raw_sales")
def _loaded_table(w: Warehouse) -> DataFrame:
    """Sales replaced and appended in two loads, scanned by the table's logical name."""

    def make() -> str:
        name, rows = _table(w, "sales"), w.raw["sales"]
        even = rows.where("store % 2 = 0")
        counts = [catalog.load(even, "raw_io", name, overwrite=True) for _ in range(2)]
        counts.append(catalog.load(rows.where("store % 2 <> 0 or store is null"), "raw_io", name))
        if counts[0] != counts[1] or counts[1] + counts[2] != catalog.table(w.spark, "raw_io", name).count():
            raise RuntimeError(f"loads counted {counts}")
        return name

    name = _once(w, "loaded_table", make)
    return catalog.table(w.spark, "raw_io", name).select(*RAW_CONTRACTS["sales"].names)


def _outputs(w: Warehouse, name: str) -> DataFrame:
    """A model output written as a file, read by its contract, and inserted twice
    (the second time replacing) into a table made from the contract (A6-A8, A10)."""

    def make() -> str:
        contract, target = ML_CONTRACTS[name], _table(w, name)
        path = write_outputs({name: w.ml[name].toDF(*[c.title() for c in w.ml[name].columns])}, _folder(w, "outputs"))[name]
        for _ in range(2):
            catalog.insert(contract_read(w.spark, path, contract), "ml_io", target, contract.columns, overwrite=True)
        return target

    return lower_columns(catalog.table(w.spark, "ml_io", _once(w, f"output-{name}", make)))


for _name, _cte in (("demand_forecasts", "lag_fc"), ("stockout_risk", "ml_stockout"), ("sales_anomalies", "ml_anomalies")):
    register(f"output_{_name}", f"select {', '.join(ML_CONTRACTS[_name].names)} from {_cte}", _cte)(
        lambda w, n=_name: _outputs(w, n))


@register("materialised_demand", "select * from fact_demand", "fact_demand")
def _materialised_demand(w: Warehouse) -> DataFrame:
    """A mart rebuilt as a table, twice; a missing object is seen as missing."""

    def make() -> str:
        name = _table(w, "fact_demand")
        if catalog.object_exists(w.spark, "marts_io", name):
            raise RuntimeError(f"{name} exists already")
        for _ in range(2):
            catalog.materialise(w.fact_demand, "marts_io", name)
        return name

    return catalog.table(w.spark, "marts_io", _once(w, "materialised_demand", make))


# -- inventory from what the loads recorded (I5, I6, C7) ---------------------------------
def _catalog(w: Warehouse) -> dict[str, str]:
    """The warehouse's layers as databases of their own: tables loaded, staging as views."""

    def make() -> dict[str, str]:
        databases = {layer: f"{layer}_{uuid.uuid4().hex[:8]}" for layer in catalog.LAYERS}
        for name, df in w.layer_tables().items():
            layer, table = name.split(".")
            if layer != catalog.STAGING:
                catalog.load(df, databases[layer], table, overwrite=True)
        for view in staging.STAGING:
            catalog.create_view(w.spark, databases[catalog.STAGING], view, staging.view_sql(view, databases[catalog.RAW]))
        catalog.create_view(w.spark, databases[catalog.STAGING], "int_sales_features",
                            marts.INT_SALES_FEATURES_SQL.format(db=databases[catalog.STAGING]))
        return databases

    return _once(w, "catalog", make)


@register("catalog_inventory", f"select table_schema, table_name, table_type, row_count from ({_INV[0]}) i", *_INV[1])
def _catalog_inventory(w: Warehouse) -> DataFrame:
    return catalog.inventory(w.spark, _catalog(w)).select("table_schema", "table_name", "table_type", "row_count")


@register("catalog_health", f"select object_name, object_type, row_count, status from ({_HEALTH}) h", *_INV[1])
def _catalog_health(w: Warehouse) -> DataFrame:
    return quality.pipeline_health(catalog.inventory(w.spark, _catalog(w))).select("object_name", "object_type", "row_count", "status")


@register("catalog_drift", f"""select table_schema || '.' || table_name object_name, row_count recorded_rows, row_count actual_rows,
  false drifted from ({_INV[0]}) i where table_type = 'BASE TABLE'""", *_INV[1])
def _catalog_drift(w: Warehouse) -> DataFrame:
    databases = _catalog(w)
    tables = [f"{databases[layer]}.{t.name}" for layer in (catalog.RAW, catalog.ML, catalog.MARTS)
              for t in w.spark.catalog.listTables(databases[layer])]
    name = F.upper(F.regexp_replace("table_name", "^([a-z]+)_[0-9a-f]{8}[.]", "$1."))
    return metrics.drift(w.spark, tables).select(name.alias("object_name"), "recorded_rows", "actual_rows", "drifted")


# -- model marts with their timestamps (B14, B15) --------------------------------------
for _name in ("fact_forecast", "fact_stockout_risk", "fact_anomalies"):
    register(f"mart_{_name}", f"select * from {_name}", _name)(lambda w, n=_name: w.table(n))


# -- optional filters (B26) ----------------------------------------------------------
@register("forecast_metrics_filtered", f"""
select coalesce({msum('predicted_demand')}, 0.0) predicted_demand, coalesce({msum('actual_demand')}, 0.0) actual_demand,
  {wape_sql()} wape, count(*) forecast_rows, cast(count_if(actual_demand is not null) as bigint) scored_rows,
  min(forecast_date) start_date, max(forecast_date) end_date
from fact_forecast where horizon_days = 0 and store_id = 3 and dept_id = 2""", "fact_forecast")
def _forecast_metrics_filtered(w: Warehouse) -> DataFrame:
    return fr.forecast_metrics(w.fact_forecast, w.fact_sales, store_id=3, dept_id=2)


@register("filtered_rows", """
select 'store' given, count(*) n from fact_forecast where store_id = 3
union all select 'dept', count(*) from fact_forecast where dept_id = 2
union all select 'horizon', count(*) from fact_forecast where horizon_days = 7
union all select 'all', count(*) from fact_forecast where store_id = 3 and dept_id = 2 and horizon_days = 7
union all select 'none', count(*) from fact_forecast""", "fact_forecast")
def _filtered_rows(w: Warehouse) -> DataFrame:
    given = {"store": {"store_id": 3}, "dept": {"dept_id": 2}, "horizon": {"horizon_days": 7},
             "all": {"store_id": 3, "dept_id": 2, "horizon_days": 7}, "none": {}}
    out = None
    for name, keys in given.items():
        part = fr.filter_keys(w.fact_forecast, **keys).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("given"), "n")
        out = part if out is None else out.unionByName(part)
    return out


# -- keys and times (B16, B32, B33) ------------------------------------------------------
@register("sku_keys", "select distinct store_id, dept_id, 'SKU-' || store_id || '-' || dept_id sku from fact_sales", "fact_sales")
def _sku_keys(w: Warehouse) -> DataFrame:
    return w.fact_sales.select("store_id", "dept_id").distinct().withColumn("sku", sku("store_id", "dept_id"))


_HOUR = "(store_id * 7 + dept_id) % 24"


@register("utc_times", f"""
select store_id, dept_id, sales_date, cast(sales_date as timestamp) + to_hours(cast({_HOUR} as int)) - to_hours(2) utc_time
from fact_sales""", "fact_sales")
def _utc_times(w: Warehouse) -> DataFrame:
    """Times as text with an offset of two hours, read as UTC wall times."""
    hour = F.lpad(F.expr(_HOUR).cast("string"), 2, "0")
    text = F.concat(F.date_format("sales_date", "yyyy-MM-dd"), F.lit("T"), hour, F.lit(":00:00.250+02:00"))
    return w.fact_sales.select(
        "store_id", "dept_id", "sales_date", coerce(text, T.StringType(), T.TimestampNTZType()).alias("utc_time"))


@register("local_times", f"""
select store_id, dept_id, sales_date, strftime(wall, '%b %d, %Y %I:%M %p') || case when behind = 4 then ' EDT' else ' EST' end local_time
from (select *, t - to_hours(behind) wall from (select *, case when t >= spring and t < autumn then 4 else 5 end behind from (
  select store_id, dept_id, sales_date, cast(sales_date as timestamp) + to_hours(cast({_HOUR} as int)) t,
    -- First Sunday of April (second of March from 2007), 07:00 UTC, to last of October (first of November), 06:00 UTC.
    cast(case when year(sales_date) < 2007 then make_date(year(sales_date), 4, 1) + cast((7 - dayofweek(make_date(year(sales_date), 4, 1))) % 7 as int)
      else make_date(year(sales_date), 3, 8) + cast((7 - dayofweek(make_date(year(sales_date), 3, 8))) % 7 as int) end as timestamp) + to_hours(7) spring,
    cast(case when year(sales_date) < 2007 then make_date(year(sales_date), 10, 25) + cast((7 - dayofweek(make_date(year(sales_date), 10, 25))) % 7 as int)
      else make_date(year(sales_date), 11, 1) + cast((7 - dayofweek(make_date(year(sales_date), 11, 1))) % 7 as int) end as timestamp) + to_hours(6) autumn
  from fact_sales) x) y) z""", "fact_sales")
def _local_times(w: Warehouse) -> DataFrame:
    time = F.col("sales_date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.expr(f"cast({_HOUR} as int)"))
    return w.fact_sales.select("store_id", "dept_id", "sales_date", local_time_text(time).alias("local_time"))


# -- row order (F1, F2, F4, F5) ------------------------------------------------------------
def _ordered(name: str, needs: tuple[str, ...], sql: str, read: Callable[[Warehouse], DataFrame], keys: list[str]) -> None:
    """A registered query of the first 200 places of a sorted read: place and key columns."""
    columns = ", ".join(keys)
    register(name, f"select {columns}, place from (select *, row_number() over (order by {sql}) place from {needs[0]}) o where place <= 200",
             *needs)(lambda w: _places(read(w), keys))


def _places(df: DataFrame, keys: list[str]) -> DataFrame:
    """The first 200 rows of a sorted frame with their places."""
    first = df.limit(200).select(F.collect_list(F.struct(*keys)).alias("rows"))
    return first.select(F.posexplode("rows").alias("at", "r")).select("r.*", (F.col("at") + 1).cast("long").alias("place"))


_ordered("forecast_results_order", ("fact_forecast",), "forecast_date, store_id, dept_id",
         lambda w: fr.forecast_results(w.fact_forecast, w.fact_sales), ["forecast_date", "store_id", "dept_id"])
_ordered("demand_detail_order", ("demand_scored",), "demand_date, store_id, dept_id",
         lambda w: scoring.demand_detail(w.fact_demand), ["demand_date", "store_id", "dept_id", "risk_category"])
_ordered("stockout_queue_order", ("fact_stockout_risk",), """case risk_category when 'Critical' then 1 when 'High' then 2
  when 'Medium' then 3 else 4 end, stockout_risk_score desc nulls first, risk_date, store_id, dept_id""",
         lambda w: scoring.stockout_queue(w.fact_stockout_risk, w.fact_demand),
         ["risk_category", "stockout_risk_score", "risk_date", "store_id", "dept_id"])
_ordered("anomaly_queue_order", ("fact_anomalies",), "is_anomaly desc, abs(anomaly_score) desc nulls last, sales_date, store_id, dept_id",
         lambda w: scoring.anomaly_queue(w.fact_anomalies, w.fact_sales),
         ["is_anomaly", "anomaly_score", "sales_date", "store_id", "dept_id"])
