"""SparkSession construction and lineage cutting.

Everything in the engine runs on one session.  The settings below are the
ones the engine relies on for correct results (UTC wall time, ANSI errors on
bad arithmetic) and for scale (AQE re-planning, skew-join splitting,
partition coalescing).  Cluster-specific sizes (executor memory, shuffle
partitions at 100 TB) come from the cluster's own spark-defaults; the
builder only fills in values that are unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Settings the engine's semantics depend on: applied to every session.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on (store, dept, date) may reuse a (store, dept) partitioning.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Sizes of aggregates follow from the stored layers' column statistics.
    "spark.sql.cbo.enabled": "true",
}

# Defaults for a fresh local session (tests, bench); a cluster keeps its own.
LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
    "spark.driver.memory": "16g",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "shelfcast", **conf: str) -> SparkSession:
    """Return the active session, creating a local one when none exists."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        for key, value in LOCAL_DEFAULTS.items():
            builder = builder.config(key, value)
    for key, value in {**REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's required runtime settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # fixed on an already running session
            if str(spark.conf.get(key, None)).lower() != value.lower():
                raise
    find_package(spark)
    checkpoint_dir(spark)
    return spark


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver runs it.

    Serves local sessions and nodes that hold the code at the same path; on
    other clusters ship it with ``--py-files`` as usual.
    """
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (a local test session) is a private temporary folder created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="shelfcast-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder.

    Used where one derived frame feeds several jobs (training, holdout
    scoring, batch scoring): a lost executor then re-reads the checkpoint
    instead of recomputing the whole upstream plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


LAYER_DB = "stored_layers"


def store_layer(df: DataFrame) -> DataFrame:
    """Store ``df`` as a Parquet table with column statistics and read it back.

    The files lie in the shared checkpoint folder, sorted by the first date
    column within each file, so scans are pruned to the columns in use and
    date filters skip row groups; statistics of the keys (integers, dates,
    words, flags) let the optimizer tell how many groups an aggregate has, so
    that group tables are broadcast by a known size.  A lost executor reads
    the files again.
    """
    spark = df.sparkSession
    name = f"{LAYER_DB}.layer_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {LAYER_DB}")
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    ordered = df.sortWithinPartitions(dates[0]) if dates else df
    path = f"{checkpoint_dir(spark).rstrip('/')}/layers/{name.split('.')[1]}"
    ordered.write.format("parquet").option("path", path).saveAsTable(name)
    keys = [f"`{f.name}`" for f in df.schema.fields
            if isinstance(f.dataType, (T.IntegralType, T.DateType, T.StringType, T.BooleanType))]
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS" + (f" FOR COLUMNS {', '.join(keys)}" if keys else ""))
    return spark.table(name)


def file_listing(spark: SparkSession, folder: str) -> tuple[tuple[str, int, int], ...]:
    """(path, bytes, modification time) of every file below ``folder``, on any Hadoop file system."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    out = []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def local_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
