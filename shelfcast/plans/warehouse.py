"""The warehouse: every layer's tables as lazily built DataFrames.

A ``Warehouse`` is given the raw landing tables (and optionally the model
output tables) and derives staging views and marts on demand.  Two ways to
get one:

* ``Warehouse.from_testdata(spark, sf_dir)``: raw tables derived from the
  TPC-H-style test tables (``sources.adapter``); model outputs are the
  deterministic lag forecast and the scorers of ``operators.scoring``.
* ``Warehouse.from_catalog(spark)``: raw, ml and marts tables saved by
  ``plans.refresh`` in the session catalog.

Frames are memoised per warehouse so one plan references one DataFrame per
table; nothing is collected.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import marts, staging


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        raw: dict[str, DataFrame],
        ml: dict[str, DataFrame] | None = None,
        tables: dict[str, DataFrame] | None = None,
    ) -> None:
        self.spark = spark
        self.raw = raw
        self._ml = ml
        self._tables = tables or {}

    # -- constructors -------------------------------------------------------
    materialize = None

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, materialize=None) -> "Warehouse":
        from ..sources.adapter import raw_tables

        w = cls(spark, raw_tables(spark, sf_dir, materialize))
        w.sf_dir = sf_dir
        w.materialize = materialize
        return w

    _SHARED: dict[tuple[str, str], tuple[tuple, "Warehouse"]] = {}

    @classmethod
    def shared(cls, spark: SparkSession, sf_dir: str) -> "Warehouse":
        """One materialised test-data warehouse per (Spark application, folder).

        Raw, model-output and mart layers are stored the first time they are
        used, as Parquet tables with column statistics (``store_layer``), and
        read by every later query, as the tables of a refreshed warehouse
        are.  When the folder's files change, the layers are derived anew.
        """
        from ..session import file_listing, store_layer

        key = (spark.sparkContext.applicationId, sf_dir)
        listing = file_listing(spark, sf_dir)
        held = cls._SHARED.get(key)
        if held is None or held[0] != listing:
            held = (listing, cls.from_testdata(spark, sf_dir, materialize=store_layer))
            cls._SHARED[key] = held
        return held[1]

    @classmethod
    def from_catalog(cls, spark: SparkSession) -> "Warehouse":
        from ..sources import catalog

        raw = {t: spark.table(f"{catalog.RAW}.{t}") for t in ("sales", "stores", "features", "inventory")}
        ml = {}
        for t in ("demand_forecasts", "stockout_risk", "sales_anomalies"):
            if catalog.object_exists(spark, catalog.ML, t):
                ml[t] = spark.table(f"{catalog.ML}.{t}")
        tables = {}
        for t in catalog.MART_TABLES:
            if catalog.object_exists(spark, catalog.MARTS, t):
                tables[t] = spark.table(f"{catalog.MARTS}.{t}")
        w = cls(spark, raw, ml, tables)
        w.catalog_backed = True
        return w

    # Marts whose build shuffles (join, distinct over a union); the others are
    # projections of stored data and stay views over it.
    STORED_MARTS = {"fact_demand", "dim_date"}

    def _table(self, name: str, build) -> DataFrame:
        if name in self._tables:
            return self._tables[name]
        df = build()
        if self.materialize and name in self.STORED_MARTS:
            df = self.materialize(df)
        self._tables[name] = df
        return df

    # -- staging ------------------------------------------------------------
    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stg_sales(self.raw["sales"])

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self.raw["stores"])

    @cached_property
    def stg_features(self) -> DataFrame:
        return staging.stg_features(self.raw["features"])

    @cached_property
    def stg_inventory(self) -> DataFrame:
        return staging.stg_inventory(self.raw["inventory"])

    @cached_property
    def int_sales_features(self) -> DataFrame:
        return marts.int_sales_features(self.stg_sales, self.stg_stores, self.stg_features)

    # -- marts --------------------------------------------------------------
    @property
    def dim_store(self) -> DataFrame:
        return self._table("dim_store", lambda: marts.dim_store(self.stg_stores))

    @property
    def dim_date(self) -> DataFrame:
        return self._table("dim_date", lambda: marts.dim_date(self.stg_sales, self.stg_features, self.stg_inventory))

    @property
    def fact_sales(self) -> DataFrame:
        return self._table("fact_sales", lambda: marts.fact_sales(self.stg_sales))

    @property
    def fact_inventory(self) -> DataFrame:
        return self._table("fact_inventory", lambda: marts.fact_inventory(self.stg_inventory))

    @property
    def fact_demand(self) -> DataFrame:
        return self._table("fact_demand", lambda: marts.fact_demand(self.stg_sales, self.stg_inventory))

    # -- model outputs and model marts -------------------------------------
    @property
    def ml(self) -> dict[str, DataFrame]:
        if self._ml is None:
            from ..operators import scoring
            from ..operators.forecast_reads import lag_forecast_output

            forecasts = lag_forecast_output(self.fact_sales)
            if self.materialize:
                forecasts = self.materialize(forecasts)
            ml = {
                "demand_forecasts": forecasts,
                "stockout_risk": scoring.stockout_output(forecasts, self.stg_inventory),
                "sales_anomalies": scoring.sales_anomaly_output(self.stg_sales),
            }
            if self.materialize:
                ml = {k: (v if k == "demand_forecasts" else self.materialize(v)) for k, v in ml.items()}
            self._ml = ml
        return self._ml

    def has(self, name: str) -> bool:
        """Whether a model mart can be served (A13): present, or its ml input is."""
        if name in self._tables:
            return True
        source = {"fact_forecast": "demand_forecasts", "fact_stockout_risk": "stockout_risk",
                  "fact_anomalies": "sales_anomalies"}.get(name)
        return source is not None and source in self.ml

    def optional(self, name: str) -> DataFrame | None:
        """The model mart if it can be served, else None (A13 switch)."""
        return self.table(name) if self.has(name) else None

    catalog_backed = False

    def inventory(self) -> DataFrame:
        """Object inventory (I5): the session catalog for a refreshed
        warehouse, the layer frames otherwise."""
        from ..operators import quality

        if self.catalog_backed:
            from ..sources import catalog

            return catalog.inventory(self.spark)
        from ..sources.adapter import ADAPTER_LOADED_AT

        return quality.tables_inventory(self.spark, self.layer_tables(), self.VIEWS, ADAPTER_LOADED_AT)

    @property
    def fact_forecast(self) -> DataFrame:
        return self._table("fact_forecast", lambda: marts.fact_forecast(self.ml["demand_forecasts"]))

    @property
    def fact_stockout_risk(self) -> DataFrame:
        return self._table("fact_stockout_risk", lambda: marts.fact_stockout_risk(self.ml["stockout_risk"]))

    @property
    def fact_anomalies(self) -> DataFrame:
        return self._table("fact_anomalies", lambda: marts.fact_anomalies(self.ml["sales_anomalies"]))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    @cached_property
    def raw_weather(self) -> DataFrame:
        if "weather" in self.raw:
            return self.raw["weather"]
        from ..operators.synth import synthetic_weather

        df = synthetic_weather(self.raw["features"])
        return self.materialize(df) if self.materialize else df

    VIEWS = {"staging.stg_sales", "staging.stg_stores", "staging.stg_features", "staging.stg_inventory",
             "staging.int_sales_features"}

    def layer_tables(self) -> dict[str, DataFrame]:
        """Every object by ``layer.table`` name (quality checks, inventory)."""
        out = {f"raw.{t}": self.raw[t] for t in ("sales", "stores", "features", "inventory")}
        out["raw.weather"] = self.raw_weather
        for t in ("stg_sales", "stg_stores", "stg_features", "stg_inventory", "int_sales_features"):
            out[f"staging.{t}"] = getattr(self, t)
        for t, df in self.ml.items():
            out[f"ml.{t}"] = df
        for t in ("dim_store", "dim_date", "fact_sales", "fact_inventory", "fact_demand", "fact_forecast",
                  "fact_stockout_risk", "fact_anomalies"):
            out[f"marts.{t}"] = getattr(self, t)
        return out
