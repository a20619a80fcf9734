"""Prepare source files into the canonical landing files.

Source headers are matched spelling-insensitively (one normaliser for both
header dialects, T12); values are typed tolerantly (bad dates and numbers
become NULL, T22).  Output frames carry the canonical file headers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import coerce, normalise_columns, require_columns
from ..sources.dates import ISO, spellings

# Source file names of the public weekly sales data set.
SOURCE_FILES = {"sales": "train.csv", "stores": "stores.csv", "features": "features.csv"}

# Canonical headers of the prepared files, per contract column.
SALES_HEADERS = {"store": "Store", "dept": "Dept", "date": "Date", "weekly_sales": "Weekly_Sales",
                 "is_holiday": "IsHoliday"}
STORES_HEADERS = {"store": "Store", "store_type": "Type", "size": "Size"}
FEATURE_HEADERS = {
    "store": "Store", "date": "Date", "temperature": "Temperature", "fuel_price": "Fuel_Price",
    "markdown1": "MarkDown1", "markdown2": "MarkDown2", "markdown3": "MarkDown3", "markdown4": "MarkDown4",
    "markdown5": "MarkDown5", "cpi": "CPI", "unemployment": "Unemployment", "is_holiday": "IsHoliday",
}
MARKDOWNS = ("markdown1", "markdown2", "markdown3", "markdown4", "markdown5")


def _types(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema.fields}


def prepare_sales(train: DataFrame) -> DataFrame:
    """Five required columns; date and numbers coerced (B3).  A vote over the
    column finds how text spells its dates (one job)."""
    df = normalise_columns(train, list(SALES_HEADERS))
    require_columns(df, list(SALES_HEADERS), "train.csv")
    t, spelled = _types(df), spellings(df, ["date"])
    typed = {
        "store": coerce(F.col("store"), t["store"], T.IntegerType()),
        "dept": coerce(F.col("dept"), t["dept"], T.IntegerType()),
        "date": coerce(F.col("date"), t["date"], T.DateType(), spelled.get("date", ISO)),
        "weekly_sales": coerce(F.col("weekly_sales"), t["weekly_sales"], T.DoubleType()),
        "is_holiday": F.col("is_holiday"),
    }
    return df.select(*[typed[c].alias(SALES_HEADERS[c]) for c in SALES_HEADERS])


def prepare_stores(stores: DataFrame) -> DataFrame:
    """Three required columns, renamed."""
    df = normalise_columns(stores, list(STORES_HEADERS))
    require_columns(df, list(STORES_HEADERS), "stores.csv")
    return df.select(*[F.col(c).alias(h) for c, h in STORES_HEADERS.items()])


def prepare_features(features: DataFrame) -> DataFrame:
    """Absent columns added (markdowns 0, others NULL); markdowns coerced
    with NULL -> 0; other measures coerced; date coerced (B5)."""
    df = normalise_columns(features, list(FEATURE_HEADERS))
    for c in FEATURE_HEADERS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(0.0) if c in MARKDOWNS else F.lit(None).cast("string"))
    t, spelled = _types(df), spellings(df, ["date"])
    cols = []
    for c, h in FEATURE_HEADERS.items():
        if c == "store":
            v = coerce(F.col(c), t[c], T.IntegerType())
        elif c == "date":
            v = coerce(F.col(c), t[c], T.DateType(), spelled.get(c, ISO))
        elif c == "is_holiday":
            v = F.col(c)
        elif c in MARKDOWNS:
            v = F.coalesce(coerce(F.col(c), t[c], T.DoubleType()), F.lit(0.0))
        else:
            v = coerce(F.col(c), t[c], T.DoubleType())
        cols.append(v.alias(h))
    return df.select(*cols)


def prepare(spark: SparkSession, source_dir: str, output_dir: str, include_synthetic: bool = True,
            seed: int = 42) -> dict[str, str]:
    """Read the three source files, write the canonical files, and optionally
    the synthetic inventory and weather files (A9, H5, H6)."""
    from ..contracts import RAW_CONTRACTS, cast_to_contract
    from ..sources.files import read_csv_strings, write_csv
    from .synth import synthetic_inventory, synthetic_weather

    base = source_dir.rstrip("/")
    sales = prepare_sales(read_csv_strings(spark, f"{base}/{SOURCE_FILES['sales']}"))
    stores = prepare_stores(read_csv_strings(spark, f"{base}/{SOURCE_FILES['stores']}"))
    features = prepare_features(read_csv_strings(spark, f"{base}/{SOURCE_FILES['features']}"))
    out = {}
    for name, frame in (("sales", sales), ("stores", stores), ("features", features)):
        out[name] = f"{output_dir.rstrip('/')}/{name}.csv"
        write_csv(frame, out[name])
    if include_synthetic:
        typed_sales = cast_to_contract(sales, RAW_CONTRACTS["sales"], date_spellings={})
        typed_features = cast_to_contract(features, RAW_CONTRACTS["features"], date_spellings={})
        inv = synthetic_inventory(typed_sales, seed)
        weather = synthetic_weather(typed_features, seed)
        for name, frame, headers in (
            ("inventory", inv, ["Store", "Dept", "Date", "SKU", "Available_Inventory", "Safety_Stock_Units",
                                "Reorder_Point_Units"]),
            ("weather", weather, ["Store", "Date", "Temperature", "Precipitation", "Snowfall"]),
        ):
            out[name] = f"{output_dir.rstrip('/')}/{name}.csv"
            write_csv(frame.toDF(*headers), out[name])
    return out
