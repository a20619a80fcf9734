"""File sources and sinks.

CSV is read with every column as a string (no schema inference, which
would need an extra pass over the data) and typed by the contract, so a bad
value becomes NULL instead of failing the job.  Paths are Hadoop URIs: the
same calls read and write local folders, HDFS or object stores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..contracts import RAW_CONTRACTS, Contract, cast_to_contract
from .quarantine import read_csv_checked, set_aside


class MissingSourceError(FileNotFoundError):
    """A required source file or folder does not exist (A1, A4)."""


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path's scheme."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """Headered CSV, every column a string; a missing path raises (A1)."""
    if not path_exists(spark, path):
        raise MissingSourceError(f"Missing source file: {path}")
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .option("nullValue", "")
        .csv(path)
    )


def contract_read(spark: SparkSession, path: str, contract: Contract, loaded_at=None,
                  rejected: Observation | None = None, quarantine: str | None = None) -> DataFrame:
    """Read one landing file into its contract.

    With ``quarantine`` (a folder) rows that don't have their header's number
    of fields are written there and left out; without it they are read as
    far as they go.

    Rename loosely spelled headers, require the contract's columns, drop
    the rest, type tolerantly, dates by a vote over their spellings; raw
    contracts also get ``source_file`` (the file name from the scan's
    metadata) and ``loaded_at`` (one UTC wall time per load).  ``rejected``
    counts dates that aren't read, when the frame is written.
    """
    if quarantine is None:
        df = read_csv_strings(spark, path)
        df = df.select("*", F.col("_metadata.file_name").alias("source_file"))
    else:
        df, bad = read_csv_checked(spark, path)
        set_aside(bad, quarantine)
    if not contract.with_load_columns:
        return cast_to_contract(df, contract, path, rejected=rejected)
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else F.current_timestamp().cast("timestamp_ntz")
    return cast_to_contract(
        df, _with_source(contract), path, rejected=rejected
    ).withColumn("loaded_at", ts)


def _with_source(contract: Contract) -> Contract:
    from pyspark.sql import types as T

    return Contract(
        contract.name, contract.file_name,
        T.StructType([*contract.columns.fields, T.StructField("source_file", T.StringType(), True)]),
        contract.with_load_columns,
    )


def validate_sources(spark: SparkSession, source_dir: str, names: list[str] | None = None,
                     contracts: dict[str, Contract] = RAW_CONTRACTS) -> dict[str, str]:
    """Resolve every requested entity to an existing file before any load (A4)."""
    names = names or list(contracts)
    unknown = [n for n in names if n not in contracts]
    if unknown:
        raise ValueError(f"Unsupported entities {unknown}; supported: {', '.join(contracts)}")
    paths = {n: f"{source_dir.rstrip('/')}/{contracts[n].file_name}" for n in names}
    missing = [p for p in paths.values() if not path_exists(spark, p)]
    if missing:
        raise MissingSourceError(f"Missing expected source files: {', '.join(missing)}")
    return paths


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV folder."""
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def stage_entities(frames: dict[str, DataFrame], uri: str, fmt: str = "csv") -> dict[str, str]:
    """Write each entity under ``<uri>/<entity>/`` on any Hadoop file system."""
    out = {}
    for name, df in frames.items():
        target = f"{uri.rstrip('/')}/{name}"
        if fmt == "csv":
            write_csv(df, target)
        else:
            write_parquet(df, target)
        out[name] = target
    return out


def read_canonical(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sales, stores and features of one landing folder, typed (A2)."""
    base = data_dir.rstrip("/")
    return tuple(contract_read(spark, f"{base}/{RAW_CONTRACTS[n].file_name}", RAW_CONTRACTS[n])
                 for n in ("sales", "stores", "features"))


def write_outputs(frames: dict[str, DataFrame], output_dir: str) -> dict[str, str]:
    """Model output files, one headered CSV folder per output (A10)."""
    out = {}
    for name, df in frames.items():
        out[name] = f"{output_dir.rstrip('/')}/{name}.csv"
        write_csv(df, out[name])
    return out


def lower_columns(df: DataFrame) -> DataFrame:
    """Result naming: every column lower case."""
    return df.toDF(*[c.lower() for c in df.columns])
