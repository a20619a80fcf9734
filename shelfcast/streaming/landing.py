"""Incremental raw loads: newly landed files appended exactly once.

The reference appends each day's files to the raw tables (A5, append mode).
Here that is a Structured Streaming query over a landing folder.  The file
source remembers which files it has read (checkpoint) and hands a
micro-batch the same files again after a failure; each micro-batch writes a
folder of its own (``batch_id=<n>``), replacing what a failed attempt left,
so re-running neither skips nor duplicates a file.  ``availableNow``
processes what has landed and stops, which fits a scheduled refresh.

Columns are bound by each file's own header: a micro-batch groups its files
by their first line and reads each group's lines under that header, so the
order and spelling of columns may differ from file to file.  Rows that don't
have their header's number of fields go to a side table (``quarantine``),
dates are read by a vote over the micro-batch, and rows are stamped with the
file name and the micro-batch's time.
"""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..contracts import RAW_CONTRACTS, Contract, cast_to_contract
from ..session import checkpoint_dir
from ..sources.quarantine import CORRUPT, split_rows

FILES_PER_BATCH = 1000


def landing_lines(spark: SparkSession, landing_dir: str, entity: str) -> DataFrame:
    """Stream of the lines of new files under ``landing_dir/entity``, with their file."""
    lines = (
        spark.readStream.option("maxFilesPerTrigger", FILES_PER_BATCH).option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv").text(f"{landing_dir.rstrip('/')}/{entity}")
    )
    return lines.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"))


def headers(lines: DataFrame) -> dict[str, list[str]]:
    """Header line -> files that begin with it (at most ``FILES_PER_BATCH`` files)."""
    placed = lines.withColumn("at", F.monotonically_increasing_id())  # follows the order within a split
    first = placed.where(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "at").alias("header"))
    out: dict[str, list[str]] = {}
    for r in first.collect():
        out.setdefault(r["header"], []).append(r["file"])
    return out


def bind(lines: DataFrame, header: str, files: list[str], contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(contract rows, rows to set aside) of the files with this header."""
    columns = next(csv.reader([header]))
    chosen = lines.sparkSession.createDataFrame([(f,) for f in files], "file string")
    own = lines.join(F.broadcast(chosen), "file", "left_semi").where((F.col("value") != header) & (F.trim("value") != ""))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "nullValue": ""}
    cells = F.from_csv("value", ", ".join(f"`{c.replace('`', '``')}` string" for c in (*columns, CORRUPT)), options)
    good, bad = split_rows(own.select("source_file", cells.alias("c")).select("source_file", "c.*"), columns)
    with_source = Contract(contract.name, contract.file_name,
                           T.StructType([*contract.columns.fields, T.StructField("source_file", T.StringType())]))
    typed = cast_to_contract(good, with_source).withColumn("loaded_at", F.current_timestamp().cast("timestamp_ntz"))
    return typed, bad


def load_new_files(spark: SparkSession, landing_dir: str, entity: str, table_path: str,
                   checkpoint: str | None = None, quarantine: str | None = None) -> StreamingQuery:
    """Append every not-yet-loaded landing file of ``entity`` to the parquet
    table at ``table_path`` and stop (``availableNow``).  Malformed rows go to
    ``quarantine`` (default: beside the table)."""
    contract = RAW_CONTRACTS[entity]
    ckpt = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/streams/raw_{entity}"
    aside = quarantine or f"{table_path.rstrip('/')}_quarantine"

    def load(lines: DataFrame, batch: int) -> None:
        parts = [bind(lines, header, files, contract) for header, files in sorted(headers(lines).items())]
        for frames, target in ((list(zip(*parts))[0], table_path), (list(zip(*parts))[1], aside)) if parts else ():
            whole = frames[0]
            for f in frames[1:]:
                whole = whole.unionByName(f)
            whole.write.mode("overwrite").parquet(f"{target.rstrip('/')}/batch_id={batch}")

    q = (
        landing_lines(spark, landing_dir, entity).writeStream.foreachBatch(load)
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return q
