"""Rows a source file got wrong: kept aside with file, text and reason (A1, A3).

A CSV row with fewer or more fields than its file's header can't be trusted,
whatever its cells would be read as.  Such rows don't reach the contract
read; they go to a side table with the file they came from, their text and
the reason, and the write counts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
QUARANTINE_SCHEMA = "source_file string, record string, reason string"


def text_schema(columns: list[str]) -> T.StructType:
    """All columns as text, and the text of a malformed row."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT)])


def reason(record: Column, expected: int, separator: str = ",") -> Column:
    """Why a row was set aside, from its text (a quote that never ends hides separators)."""
    fields = F.size(F.split(record, f"[{separator}]"))
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    return F.when(quotes % 2 == 1, F.lit("a quote without its end")).otherwise(
        F.format_string(f"%d fields instead of {expected}", fields))


def split_rows(rows: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows as their header has them, rows to set aside) of a frame read with
    ``text_schema`` and a ``source_file`` column."""
    good = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = rows.where(F.col(CORRUPT).isNotNull()).select(
        "source_file", F.col(CORRUPT).alias("record"), reason(F.col(CORRUPT), len(columns)).alias("reason"))
    return good, bad


def read_csv_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(well-formed rows as text with ``source_file``, rows to set aside) of a headered CSV file or folder."""
    from .files import MissingSourceError, path_exists

    if not path_exists(spark, path):
        raise MissingSourceError(f"Missing source file: {path}")
    columns = spark.read.option("header", True).csv(path).columns
    rows = (
        spark.read.schema(text_schema(columns)).option("header", True).option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT).option("nullValue", "").option("columnPruning", False).csv(path)
    )
    # Spark refuses reads of the malformed text alone: this always holds, and names a column.
    rows = rows.where(F.length(F.coalesce(F.col(f"`{columns[0]}`"), F.lit(""))) >= 0)
    return split_rows(rows.select("*", F.col("_metadata.file_name").alias("source_file")), columns)


def set_aside(bad: DataFrame, target: str, mode: str = "append") -> int:
    """Write the rows to the side table at ``target``; how many there were."""
    seen = Observation("rows set aside")
    bad.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(target)
    return int(seen.get["rows"])
