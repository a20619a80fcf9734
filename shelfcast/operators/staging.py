"""Typed staging views over the raw tables.

Each view is declared once as (source column, type, output name) triples;
the same declaration builds the DataFrame projection and the SQL text of
the persistent view (``CREATE OR REPLACE VIEW``), so the two cannot drift.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOAD = [("source_file", None, "source_file"), ("loaded_at", None, "loaded_at")]

STAGING: dict[str, tuple[str, list[tuple[str, str | None, str]]]] = {
    "stg_sales": ("sales", [
        ("store", "int", "store_id"), ("dept", "int", "dept_id"), ("date", "date", "sales_date"),
        ("weekly_sales", "double", "weekly_sales"), ("is_holiday", "boolean", "is_holiday"), *LOAD,
    ]),
    "stg_stores": ("stores", [
        ("store", "int", "store_id"), ("store_type", "string", "store_type"), ("size", "bigint", "store_size"), *LOAD,
    ]),
    "stg_features": ("features", [
        ("store", "int", "store_id"), ("date", "date", "feature_date"),
        *[(m, "double", m) for m in ("temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4",
                                     "markdown5", "cpi", "unemployment")],
        ("is_holiday", "boolean", "is_holiday"), *LOAD,
    ]),
    "stg_inventory": ("inventory", [
        ("store", "int", "store_id"), ("dept", "int", "dept_id"), ("date", "date", "inventory_date"),
        ("sku", "string", "sku"), ("available_inventory", "double", "available_inventory"),
        ("safety_stock_units", "double", "safety_stock_units"), ("reorder_point_units", "double", "reorder_point_units"),
        *LOAD,
    ]),
}


def stage(raw: DataFrame, view: str) -> DataFrame:
    """The staging projection of one raw table as a DataFrame."""
    _, cols = STAGING[view]
    return raw.select(*[(F.col(src).cast(t) if t else F.col(src)).alias(out) for src, t, out in cols])


def view_sql(view: str, raw_db: str = "raw") -> str:
    """The same projection as the body of a persistent view."""
    source, cols = STAGING[view]
    items = ", ".join(f"CAST(`{src}` AS {t.upper()}) AS `{out}`" if t else f"`{src}` AS `{out}`" for src, t, out in cols)
    return f"SELECT {items} FROM {raw_db}.{source}"


def stg_sales(raw_sales: DataFrame) -> DataFrame:
    return stage(raw_sales, "stg_sales")


def stg_stores(raw_stores: DataFrame) -> DataFrame:
    return stage(raw_stores, "stg_stores")


def stg_features(raw_features: DataFrame) -> DataFrame:
    return stage(raw_features, "stg_features")


def stg_inventory(raw_inventory: DataFrame) -> DataFrame:
    return stage(raw_inventory, "stg_inventory")
