"""The batch refresh: prepare -> load raw -> train -> score -> marts -> checks.

The stages of the reference's daily refresh run here as plain function
calls on one SparkSession (no subprocesses, no staging CSV hop between
scoring and loading).  Each stage reads the catalog tables written by the
previous one, so a failed run restarts from the last finished stage, and a
lost executor recomputes at most one stage's input from stored tables.

Fact tables can be bucketed by (store_id, dept_id): the per-group scorers
and the (store, dept, date) joins then read co-partitioned data without a
shuffle.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..contracts import ML_CONTRACTS, RAW_CONTRACTS
from ..operators import features, forest, marts, quality, scoring, staging
from ..operators.prepare import prepare
from ..sources import catalog, ledger
from ..sources.files import contract_read, validate_sources
from .warehouse import Warehouse

FACT_DATE = {"fact_sales": "sales_date", "fact_inventory": "inventory_date", "fact_demand": "demand_date",
             "fact_forecast": "forecast_date", "fact_stockout_risk": "risk_date", "fact_anomalies": "sales_date"}


@dataclass
class RefreshConfig:
    landing_dir: str
    model_dir: str
    source_dir: str | None = None
    entities: tuple[str, ...] = tuple(RAW_CONTRACTS)
    include_synthetic: bool = True
    seed: int = 42
    overwrite: bool = True
    repeatable: bool = False  # raw loads by the load ledger
    skip_prepare: bool = False
    skip_load: bool = False
    skip_train: bool = False
    skip_score: bool = False
    skip_marts: bool = False
    skip_tests: bool = False
    dry_run: bool = False
    buckets: int = 0
    forest: forest.ForestParams = field(default_factory=forest.ForestParams)
    run_at: _dt.datetime | None = None


def plan_steps(cfg: RefreshConfig) -> list[str]:
    """The ordered stage names this configuration runs."""
    steps = []
    if cfg.source_dir and not cfg.skip_prepare:
        steps.append("prepare")
    for name, skip in (("load_raw", cfg.skip_load), ("train", cfg.skip_train), ("score", cfg.skip_score),
                       ("build_marts", cfg.skip_marts), ("test_marts", cfg.skip_tests)):
        if not skip:
            steps.append(name)
    return steps


def load_raw(spark: SparkSession, landing_dir: str, entities=tuple(RAW_CONTRACTS), overwrite: bool = True,
             loaded_at: _dt.datetime | None = None, repeatable: bool = False) -> dict[str, int]:
    """Validate every file first, then load each into raw.<entity> (A3-A5);
    rows added by entity.  ``repeatable``: by the load ledger, so that files
    already loaded add nothing and a failed load changes nothing."""
    paths = validate_sources(spark, landing_dir, list(entities))
    stamp = loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    if repeatable:
        return {
            name: sum(ledger.load_files(
                spark, catalog.RAW, name, RAW_CONTRACTS[name].table_schema, [path],
                lambda p, c=RAW_CONTRACTS[name]: contract_read(spark, p, c, stamp), overwrite).values())
            for name, path in paths.items()
        }
    return {
        name: catalog.load(contract_read(spark, path, RAW_CONTRACTS[name], stamp), catalog.RAW, name, overwrite)
        for name, path in paths.items()
    }


def load_outputs(spark: SparkSession, output_dir: str, only: tuple[str, ...] = tuple(ML_CONTRACTS),
                 overwrite: bool = True, repeatable: bool = False) -> dict[str, int]:
    """Model output files -> ml tables: validate all, ensure, typed insert
    (A6-A8), or by the load ledger."""
    paths = validate_sources(spark, output_dir, list(only), ML_CONTRACTS)
    if repeatable:
        return {
            name: sum(ledger.load_files(
                spark, catalog.ML, name, ML_CONTRACTS[name].columns, [path],
                lambda p, c=ML_CONTRACTS[name]: contract_read(spark, p, c), overwrite).values())
            for name, path in paths.items()
        }
    return {
        name: catalog.insert(contract_read(spark, path, ML_CONTRACTS[name]), catalog.ML, name,
                             ML_CONTRACTS[name].columns, overwrite)
        for name, path in paths.items()
    }


def _raw(spark: SparkSession, name: str) -> DataFrame:
    return catalog.table(spark, catalog.RAW, name)


def training_frame_from_catalog(spark: SparkSession) -> DataFrame:
    return features.training_frame(_raw(spark, "sales"), _raw(spark, "stores"), _raw(spark, "features"))


def train(spark: SparkSession, cfg: RefreshConfig) -> forest.TrainedForecast:
    trained = forest.train(training_frame_from_catalog(spark), cfg.forest, cfg.run_at)
    forest.save(trained, cfg.model_dir)
    return trained


def score(spark: SparkSession, cfg: RefreshConfig, trained: forest.TrainedForecast | None = None) -> dict[str, int]:
    """Forecasts, stockout risk and anomalies into the ml tables."""
    trained = trained or forest.load(cfg.model_dir)
    created = cfg.run_at or _dt.datetime.now(_dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    frame = training_frame_from_catalog(spark)
    out = {}
    fc = forest.forecast_output(frame, trained, created)
    out["demand_forecasts"] = catalog.insert(fc, catalog.ML, "demand_forecasts",
                                             ML_CONTRACTS["demand_forecasts"].columns, cfg.overwrite)
    forecasts = catalog.table(spark, catalog.ML, "demand_forecasts")
    inventory = staging.stg_inventory(_raw(spark, "inventory")) if catalog.object_exists(
        spark, catalog.RAW, "inventory") else None
    out["stockout_risk"] = catalog.insert(scoring.stockout_output(forecasts, inventory), catalog.ML, "stockout_risk",
                                          ML_CONTRACTS["stockout_risk"].columns, cfg.overwrite)
    out["sales_anomalies"] = catalog.insert(
        scoring.sales_anomaly_output(staging.stg_sales(_raw(spark, "sales")), created_at=created), catalog.ML,
        "sales_anomalies", ML_CONTRACTS["sales_anomalies"].columns, cfg.overwrite)
    return out


def _save_mart(df: DataFrame, name: str, buckets: int) -> int:
    if buckets and name in FACT_DATE:
        return catalog.load(df, catalog.MARTS, name, True, (buckets, ("store_id", "dept_id"), FACT_DATE[name]))
    return catalog.materialise(df, catalog.MARTS, name)


def build_marts(spark: SparkSession, buckets: int = 0) -> dict[str, int]:
    """Staging views (SQL over raw), then every mart table, full rebuild."""
    for view in staging.STAGING:
        catalog.create_view(spark, catalog.STAGING, view, staging.view_sql(view, catalog.RAW))
    catalog.create_view(spark, catalog.STAGING, "int_sales_features",
                        marts.INT_SALES_FEATURES_SQL.format(db=catalog.STAGING))
    stg = {v: catalog.table(spark, catalog.STAGING, v) for v in staging.STAGING}
    built = {
        "dim_store": lambda: marts.dim_store(stg["stg_stores"]),
        "dim_date": lambda: marts.dim_date(stg["stg_sales"], stg["stg_features"], stg["stg_inventory"]),
        "fact_sales": lambda: marts.fact_sales(stg["stg_sales"]),
        "fact_inventory": lambda: marts.fact_inventory(stg["stg_inventory"]),
        "fact_demand": lambda: marts.fact_demand(stg["stg_sales"], stg["stg_inventory"]),
    }
    ml_marts = {
        "fact_forecast": ("demand_forecasts", marts.fact_forecast),
        "fact_stockout_risk": ("stockout_risk", marts.fact_stockout_risk),
        "fact_anomalies": ("sales_anomalies", marts.fact_anomalies),
    }
    for name, (source, fn) in ml_marts.items():
        if catalog.object_exists(spark, catalog.ML, source):
            built[name] = (lambda s=source, f=fn: f(catalog.table(spark, catalog.ML, s)))
    return {name: _save_mart(build(), name, buckets) for name, build in built.items()}


def catalog_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Every existing layer object by ``layer.table`` (for the checks)."""
    out = {}
    for db in catalog.LAYERS:
        if spark.catalog.databaseExists(db):
            for t in spark.catalog.listTables(db):
                out[f"{db}.{t.name}"] = spark.table(f"{db}.{t.name}")
    return out


def test_marts(spark: SparkSession) -> dict[str, list[dict]]:
    """Run the declared checks; small result rows are returned."""
    tables = catalog_tables(spark)
    return {
        "not_null": [r.asDict() for r in quality.not_null_report(tables).collect()],
        "unique": [r.asDict() for r in quality.unique_report(tables).collect()],
        "relationships": [r.asDict() for r in quality.relationship_report(tables).collect()],
    }


def refresh(spark: SparkSession, cfg: RefreshConfig) -> dict[str, object]:
    """Run the configured stages in order; returns each stage's result."""
    steps = plan_steps(cfg)
    if cfg.dry_run:
        return {"steps": steps}
    results: dict[str, object] = {"steps": steps}
    trained = None
    for step in steps:
        if step == "prepare":
            results[step] = prepare(spark, cfg.source_dir, cfg.landing_dir, cfg.include_synthetic, cfg.seed)
        elif step == "load_raw":
            results[step] = load_raw(spark, cfg.landing_dir, cfg.entities, cfg.overwrite, cfg.run_at, cfg.repeatable)
        elif step == "train":
            trained = train(spark, cfg)
            results[step] = {k: v for k, v in trained.metrics.items() if not isinstance(v, dict)}
        elif step == "score":
            results[step] = score(spark, cfg, trained)
        elif step == "build_marts":
            results[step] = build_marts(spark, cfg.buckets)
        elif step == "test_marts":
            results[step] = test_marts(spark)
    return results


def catalog_warehouse(spark: SparkSession) -> Warehouse:
    """Read access to a refreshed catalog (marts served as stored tables)."""
    return Warehouse.from_catalog(spark)


__all__ = ["RefreshConfig", "plan_steps", "refresh", "load_raw", "load_outputs", "train", "score", "build_marts",
           "test_marts", "catalog_warehouse"]
