"""Repeatable loads: a table's partitions are the ledger of its source files.

Each source file becomes one partition of its table, named by the file's
name, size and checksum.  A load writes the rows of files that the catalog
doesn't hold yet into their partition folders, which no reader sees, and then
publishes all of them with one ``ALTER TABLE .. ADD PARTITION``.  So

* a rerun adds nothing twice: the files' partitions are there already;
* a load that fails while reading or writing leaves the table as it was, and
  what it left in unpublished folders is overwritten by the next attempt;
* a file whose content changed is a new file (appended, or with ``replace``
  taking the place of everything the load doesn't name).

With ``replace`` the new partitions are added before the others are dropped:
a run that dies between the two statements is finished by its rerun.

The checksum adds up 64-bit hashes of a file's lines, in one aggregate over
the text, so a file of any size is read in parallel.  Files of a load are
fingerprinted together in one job.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import catalog, metrics

KEY = "load_key"


@dataclass(frozen=True)
class SourceFile:
    """A source file (or a folder of part files) as it was when it was read."""

    path: str
    size: int
    checksum: str

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]

    @property
    def key(self) -> str:
        """Partition value: a readable name, the size, and a digest of name and checksum."""
        digest = hashlib.sha256(f"{self.name}\0{self.checksum}".encode()).hexdigest()[:32]
        return f"{re.sub(r'[^A-Za-z0-9_.]', '_', self.name)}-{self.size}-{digest}"


def fingerprint(spark: SparkSession, paths: list[str]) -> list[SourceFile]:
    """Size and checksum of each file or folder, from one aggregate over their lines."""
    if not paths:
        return []
    lines = None
    for i, path in enumerate(paths):
        part = spark.read.text(path).select(
            F.lit(i).alias("i"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), "value")
        lines = part if lines is None else lines.unionByName(part)
    per_file = lines.groupBy("i", "file").agg(
        F.max("size").alias("size"), F.count(F.lit(1)).alias("lines"),
        F.sum(F.xxhash64("value").cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64("value", F.lit(1))).alias("mixed"))
    found = {r["i"]: r for r in per_file.groupBy("i").agg(
        F.sum("size").alias("size"), F.sum("lines").alias("lines"), F.sum("total").alias("total"),
        F.bit_xor("mixed").alias("mixed")).collect()}  # a row for each path
    out = []
    for i, path in enumerate(paths):
        r = found.get(i)  # no row: a file without lines
        text = f"{r['lines']}:{r['total']}:{r['mixed']}" if r else "0"
        out.append(SourceFile(path, r["size"] if r else 0, hashlib.sha256(text.encode()).hexdigest()))
    return out


def ensure(spark: SparkSession, db: str, name: str, schema: T.StructType) -> None:
    """The partitioned table, created when absent; an existing one must have the columns."""
    catalog.ensure_database(spark, db)
    if not catalog.object_exists(spark, db, name):
        spark.sql(f"CREATE TABLE {db}.{name} ({catalog.ddl(schema)}, `{KEY}` STRING) USING parquet PARTITIONED BY (`{KEY}`) {metrics.EMPTY}")
    have = spark.table(f"{db}.{name}").columns
    missing = [c for c in (*schema.names, KEY) if c not in have]
    if missing:
        raise ValueError(f"{db}.{name} lacks columns: {', '.join(missing)}")


def published(spark: SparkSession, db: str, name: str) -> list[str]:
    """Keys of the loaded files; the catalog is asked, no data is read."""
    rows = spark.sql(f"SHOW PARTITIONS {db}.{name}").collect()  # a row for each loaded file
    return [r["partition"].split("=", 1)[1] for r in rows]


def _location(spark: SparkSession, db: str, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {db}.{name}")
    return described.where("col_name = 'Location'").first()["data_type"].rstrip("/")


def load_files(spark: SparkSession, db: str, name: str, schema: T.StructType, paths: list[str],
               read: Callable[[str], DataFrame], replace: bool = False) -> dict[str, int]:
    """Load the files that ``db.name`` doesn't hold yet; key -> rows of what was added.

    ``read`` turns a path into a frame with the columns of ``schema``.
    """
    ensure(spark, db, name, schema)
    files = {f.key: f for f in fingerprint(spark, paths)}
    held = set(published(spark, db, name))
    new = {k: f for k, f in files.items() if k not in held}
    location, rows, bounds = _location(spark, db, name), {}, []
    for key, file in new.items():
        seen = Observation(f"rows of {key}")
        frame = read(file.path).select(*[F.col(c.name).cast(c.dataType).alias(c.name) for c in schema.fields])
        metrics.observed(frame, seen).write.mode("overwrite").parquet(f"{location}/{KEY}={key}")
        rows[key] = int(seen.get["rows"])
        bounds += [seen.get["first"], seen.get["last"]]
    if new:
        spark.sql(f"ALTER TABLE {db}.{name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (`{KEY}` = '{k}')" for k in new))
    gone = sorted(held - set(files)) if replace else []
    if gone:
        spark.sql(f"ALTER TABLE {db}.{name} DROP IF EXISTS " + ", ".join(f"PARTITION (`{KEY}` = '{k}')" for k in gone))
    if new or gone:
        spark.catalog.refreshTable(f"{db}.{name}")
    if gone:  # what is left is counted: files unchanged since an earlier load, and the new ones
        left = spark.table(f"{db}.{name}")
        date = metrics.date_column(left)
        bound = F.col(date).cast("string") if date else F.lit(None).cast("string")
        n, first, last = left.agg(F.count(F.lit(1)), F.min(bound), F.max(bound)).first()
        metrics.record(spark, f"{db}.{name}", n, first, last, replaced=True)
    elif new:
        known = sorted(b for b in bounds if b)
        metrics.record(spark, f"{db}.{name}", sum(rows.values()), *(known[:1] + known[-1:] or [None, None]), replaced=False)
    return rows


def ledger(spark: SparkSession, db: str, name: str) -> DataFrame:
    """file_name, file_size, load_key and row_count of each loaded file."""
    table = spark.table(f"{db}.{name}")
    counts = table.groupBy(KEY).agg(F.count(F.lit(1)).alias("row_count"))
    keys = spark.createDataFrame([(k,) for k in published(spark, db, name)], f"{KEY} string")
    named = keys.select(
        F.regexp_extract(KEY, "^(.*)-([0-9]+)-[0-9a-f]+$", 1).alias("file_name"),
        F.regexp_extract(KEY, "^(.*)-([0-9]+)-[0-9a-f]+$", 2).cast("long").alias("file_size"), KEY)
    return named.join(counts, KEY, "left").select("file_name", "file_size", KEY, F.coalesce("row_count", F.lit(0)).alias("row_count"))
