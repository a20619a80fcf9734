"""What tables hold, kept as table properties by the loads themselves.

Each load observes the rows it writes and their first and last date, in the
write's own job, and adds them to what the table's properties say.  Health
pages read the properties: no data is scanned.  ``drift`` compares them with
real counts, for tables that something else may have written to.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PREFIX = "engine."
ROWS, FIRST, LAST, CREATED, ALTERED = (PREFIX + n for n in ("rows", "first_date", "last_date", "created", "altered"))


# Of a table that a load creates without rows.
EMPTY = f"TBLPROPERTIES ('{ROWS}' = '0')"


def date_column(df: DataFrame) -> str | None:
    """The table's date: its first column of that type."""
    return next((f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)), None)


def observed(df: DataFrame, observation: Observation) -> DataFrame:
    """``df`` with its rows and date bounds observed while it is written."""
    date = date_column(df)
    bound: Column = F.col(f"`{date}`").cast("string") if date else F.lit(None).cast("string")
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.min(bound).alias("first"), F.max(bound).alias("last"))


def properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The engine's properties of a table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows if r["key"].startswith(PREFIX)}


def record(spark: SparkSession, table: str, rows: int, first: str | None, last: str | None, replaced: bool,
           at: _dt.datetime | None = None) -> None:
    """Add a load to the table's properties, or let it take their place."""
    now = (at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).isoformat(sep=" ", timespec="seconds")
    held = properties(spark, table)
    if not replaced and ROWS not in held:
        return  # something else wrote the table: what it holds isn't known
    before = {} if replaced else held
    bounds = [x for x in (before.get(FIRST), before.get(LAST), first, last) if x]
    values = {ROWS: str(int(before.get(ROWS, 0)) + rows), CREATED: held.get(CREATED, now), ALTERED: now}
    if bounds:
        values |= {FIRST: min(bounds), LAST: max(bounds)}
    elif FIRST in held:
        spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{FIRST}', '{LAST}')")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in values.items()) + ")")


def record_observed(spark: SparkSession, table: str, observation: Observation, replaced: bool) -> int:
    """Record what a finished write observed; its rows."""
    seen = observation.get
    record(spark, table, int(seen["rows"]), seen["first"], seen["last"], replaced)
    return int(seen["rows"])


def drift(spark: SparkSession, tables: list[str]) -> DataFrame:
    """table, recorded_rows, actual_rows, recorded and actual date bounds, drifted:
    one aggregate a table (the one place that reads the data)."""
    parts = []
    for table in tables:
        held, df = properties(spark, table), spark.table(table)
        date = date_column(df)
        bound = F.col(f"`{date}`").cast("string") if date else F.lit(None).cast("string")
        recorded = F.lit(int(held[ROWS]) if ROWS in held else None).cast("long")
        parts.append(df.agg(
            F.lit(table).alias("table_name"), recorded.alias("recorded_rows"), F.count(F.lit(1)).alias("actual_rows"),
            F.lit(held.get(FIRST)).cast("string").alias("recorded_first"), F.min(bound).alias("actual_first"),
            F.lit(held.get(LAST)).cast("string").alias("recorded_last"), F.max(bound).alias("actual_last")))
    same = F.lit(True)
    for c in ("rows", "first", "last"):
        same = same & F.col(f"recorded_{c}").eqNullSafe(F.col(f"actual_{c}"))
    return reduce(DataFrame.unionByName, parts).withColumn("drifted", ~same)
