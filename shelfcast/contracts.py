"""Fixed table contracts: column order and types for every layer.

Column names are lower case throughout (result naming, A15).  Raw and model
output contracts are the landing shapes; ``cast_to_contract`` brings any
frame with loosely spelled headers into one of them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sources.dates import ISO, observe_rejected, parse_date, spellings, text_dates

S, I, L, D, B, DT, TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.DateType(),
    T.TimestampNTZType(),
)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


LOAD_COLUMNS = (("source_file", S), ("loaded_at", TS))


@dataclass(frozen=True)
class Contract:
    """A landing table: data columns, which of them are dates/timestamps."""

    name: str
    file_name: str
    columns: T.StructType
    with_load_columns: bool = True

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.columns.fields]

    @property
    def table_schema(self) -> T.StructType:
        if not self.with_load_columns:
            return self.columns
        return _schema(*[(f.name, f.dataType) for f in self.columns.fields], *LOAD_COLUMNS)


# Raw landing tables (one per source CSV).
RAW_CONTRACTS: dict[str, Contract] = {
    "sales": Contract(
        "sales", "sales.csv",
        _schema(("store", I), ("dept", I), ("date", DT), ("weekly_sales", D), ("is_holiday", B)),
    ),
    "stores": Contract(
        "stores", "stores.csv",
        _schema(("store", I), ("store_type", S), ("size", L)),
    ),
    "features": Contract(
        "features", "features.csv",
        _schema(
            ("store", I), ("date", DT), ("temperature", D), ("fuel_price", D),
            ("markdown1", D), ("markdown2", D), ("markdown3", D), ("markdown4", D), ("markdown5", D),
            ("cpi", D), ("unemployment", D), ("is_holiday", B),
        ),
    ),
    "inventory": Contract(
        "inventory", "inventory.csv",
        _schema(
            ("store", I), ("dept", I), ("date", DT), ("sku", S),
            ("available_inventory", D), ("safety_stock_units", D), ("reorder_point_units", D),
        ),
    ),
    "weather": Contract(
        "weather", "weather.csv",
        _schema(("store", I), ("date", DT), ("temperature", D), ("precipitation", D), ("snowfall", D)),
    ),
}

# Model output tables (ml layer); no load columns, created_at is in the data.
ML_CONTRACTS: dict[str, Contract] = {
    "demand_forecasts": Contract(
        "demand_forecasts", "demand_forecasts.csv",
        _schema(
            ("store", I), ("dept", I), ("forecast_date", DT), ("horizon_days", I),
            ("predicted_demand", D), ("actual_demand", D),
            ("prediction_interval_lower", D), ("prediction_interval_upper", D),
            ("model_name", S), ("model_version", S), ("trained_at", TS), ("created_at", TS),
        ),
        with_load_columns=False,
    ),
    "stockout_risk": Contract(
        "stockout_risk", "stockout_risk.csv",
        _schema(
            ("store", I), ("dept", I), ("risk_date", DT), ("predicted_demand", D),
            ("available_inventory", D), ("stockout_risk_score", D), ("risk_category", S),
            ("recommended_action", S), ("model_version", S), ("created_at", TS),
        ),
        with_load_columns=False,
    ),
    "sales_anomalies": Contract(
        "sales_anomalies", "sales_anomalies.csv",
        _schema(
            ("store", I), ("dept", I), ("sales_date", DT), ("weekly_sales", D),
            ("anomaly_score", D), ("is_anomaly", B), ("severity", S), ("direction", S),
            ("model_version", S), ("created_at", TS),
        ),
        with_load_columns=False,
    ),
}

# Header spellings that do not reduce to a contract name by the rule below.
# Alias key (alphanumerics only, upper case) -> contract column.
HEADER_ALIASES = {
    "TYPE": "store_type",
}


def header_key(name: str) -> str:
    """Spelling-insensitive key of a header: alphanumerics only, upper case.

    ``Weekly_Sales``, ``WeeklySales`` and ``Weekly Sales`` share one key, as
    do ``MarkDown_1`` and ``MarkDown1``, ``IsHoliday`` and ``Is_Holiday``.
    """
    return re.sub(r"[^0-9A-Za-z]+", "", name.strip()).upper()


def normalise_header(name: str, known: list[str] | tuple[str, ...]) -> str:
    """Map a source header onto a contract column (B1, B2), else snake case it."""
    key = header_key(name)
    lookup = {header_key(column): column for column in known}
    if key in lookup:
        return lookup[key]
    if key in HEADER_ALIASES and HEADER_ALIASES[key] in known:
        return HEADER_ALIASES[key]
    return re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_").lower()


def normalise_columns(df: DataFrame, known: list[str] | tuple[str, ...]) -> DataFrame:
    """Rename every column of ``df`` by ``normalise_header`` (no job runs)."""
    return df.toDF(*[normalise_header(c, known) for c in df.columns])


class MissingColumnsError(ValueError):
    """A source lacks columns its contract requires (I4)."""


def require_columns(df: DataFrame, required: list[str] | tuple[str, ...], what: str) -> None:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"{what} is missing required columns: {', '.join(missing)}")


TRUTHY_WORDS = ("true", "1", "yes")  # fixed values: words read as true


def truthy(col: Column) -> Column:
    """Boolean from any spelling: true/1/yes (any case) -> true, all else false."""
    return F.coalesce(F.lower(F.trim(col.cast("string"))).isin(*TRUTHY_WORDS), F.lit(False))


def coerce(col: Column, source: T.DataType, target: T.DataType, spelling: str = "iso") -> Column:
    """Tolerant cast: unparseable values become NULL, NaN becomes NULL.

    ``spelling`` says how text spells dates (``sources.dates``)."""
    if source == target and not isinstance(target, (T.DoubleType, T.FloatType)):
        return col
    if isinstance(target, T.BooleanType):
        if isinstance(source, T.BooleanType):
            return col
        return F.when(col.isNull(), F.lit(None).cast("boolean")).otherwise(truthy(col))
    if isinstance(target, (T.IntegerType, T.LongType)):
        if isinstance(source, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            return col.cast(target)
        as_double = col.try_cast("double") if not isinstance(source, T.DoubleType) else col
        return F.round(F.nanvl(as_double, F.lit(None).cast("double"))).try_cast(target)
    if isinstance(target, T.DoubleType):
        value = col if isinstance(source, T.DoubleType) else col.try_cast("double")
        return F.nanvl(value, F.lit(None).cast("double"))
    if isinstance(target, T.DateType):
        if isinstance(source, (T.TimestampType, T.TimestampNTZType)):
            return col.cast("date")
        return parse_date(col, spelling)
    if isinstance(target, T.TimestampNTZType):
        if isinstance(source, T.TimestampNTZType):
            return col
        if isinstance(source, (T.TimestampType, T.DateType)):
            return col.cast(target)
        # Offsets such as +00:00 are honoured, then the UTC wall time is kept
        # at second precision.
        return F.date_trunc("second", F.try_to_timestamp(F.trim(col.cast("string")))).cast("timestamp_ntz")
    return col.cast(target)


def date_columns(contract: Contract) -> list[str]:
    return [f.name for f in contract.columns.fields if isinstance(f.dataType, T.DateType)]


def cast_to_contract(df: DataFrame, contract: Contract, what: str | None = None,
                     date_spellings: dict[str, str] | None = None, rejected: Observation | None = None) -> DataFrame:
    """Rename -> required-column check -> tolerant cast -> contract order.

    Text dates are read in the spelling that a vote over the column finds
    (one job), or in those given by ``date_spellings`` (no job; columns not
    named there are ISO).  ``rejected`` counts, by date column, the values
    that were not read, in the job that writes the frame.
    """
    named = normalise_columns(df, contract.names)
    require_columns(named, contract.names, what or contract.file_name)
    types = {f.name: f.dataType for f in named.schema.fields}
    if date_spellings is None:
        date_spellings = spellings(named, date_columns(contract))
    if rejected is not None:
        text = text_dates(named, date_columns(contract))
        named = observe_rejected(named, {c: date_spellings.get(c, ISO) for c in text}, rejected)
    return named.select(
        *[coerce(F.col(f.name), types[f.name], f.dataType, date_spellings.get(f.name, ISO)).alias(f.name)
          for f in contract.columns.fields]
    )
