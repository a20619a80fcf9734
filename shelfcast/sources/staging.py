"""Copying landing files, byte for byte, to any Hadoop file system.

Landing files lie where the caller runs (the reference uploads a local
folder), so they are streamed from there by Hadoop's own file systems, some
at a time, none held in memory.  A file is copied under a temporary name,
renamed when its length agrees, and listed in the manifest, which is written
last, only after the checksums of source and target (one Spark aggregate
over both, see ``ledger.fingerprint``) agree.  A rerun copies what the
manifest doesn't hold with this content, and nothing else.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .files import MissingSourceError, path_exists
from .ledger import fingerprint

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "name string, size long, checksum string"


class StagingError(RuntimeError):
    """A copy doesn't equal its source."""


@dataclass(frozen=True)
class Copy:
    """One file to copy: where from, where to, its bytes."""

    source: str
    target: str
    size: int


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _files(spark: SparkSession, source: str, target: str) -> list[Copy]:
    """The files of a path (itself, or all below a folder) and their places at the target."""
    path, fs = _path(spark, source)
    base = fs.getFileStatus(path).getPath().toString().rstrip("/")
    listed, out = fs.listFiles(path, True), []
    while listed.hasNext():
        f = listed.next()
        name = f.getPath().toString()
        if not f.getPath().getName().startswith("."):
            out.append(Copy(name, target + name[len(base):], int(f.getLen())))
    return out


def copy_file(spark: SparkSession, copy: Copy) -> None:
    """Stream one file to its place; nothing stands there before its length agrees."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, source_fs = _path(spark, copy.source)
    target, target_fs = _path(spark, copy.target)
    folder, name = copy.target.rsplit("/", 1)
    part, _ = _path(spark, f"{folder}/.{name}.copying")
    hadoop.FileUtil.copy(source_fs, source, target_fs, part, False, True, spark.sparkContext._jsc.hadoopConfiguration())
    if target_fs.getFileStatus(part).getLen() != copy.size:
        raise StagingError(f"{copy.source}: the copy has another length")
    if target_fs.exists(target):
        target_fs.delete(target, False)
    if not target_fs.rename(part, target):
        raise StagingError(f"{copy.target}: could not be renamed into place")


def read_manifest(spark: SparkSession, uri: str) -> dict[str, tuple[int, str]]:
    """name -> (size, checksum) of what is staged (a row for each landing file)."""
    path = f"{uri.rstrip('/')}/{MANIFEST}"
    if not path_exists(spark, path):
        return {}
    return {r["name"]: (r["size"], r["checksum"]) for r in spark.read.schema(MANIFEST_SCHEMA).json(path).collect()}


def stage_files(spark: SparkSession, paths: list[str], uri: str, at_a_time: int = 8) -> list[str]:
    """Copy landing files (or folders of part files) below ``uri``; the names of those copied."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise MissingSourceError(f"Missing source files: {', '.join(missing)}")
    base = uri.rstrip("/")
    held = read_manifest(spark, base)
    sources = {f.name: f for f in fingerprint(spark, paths)}
    changed = {n: f for n, f in sources.items() if held.get(n) != (f.size, f.checksum) or not path_exists(spark, f"{base}/{n}")}
    if not changed:
        return []
    for name in changed:  # part files of an earlier version must not stay
        old, fs = _path(spark, f"{base}/{name}")
        if fs.exists(old):
            fs.delete(old, True)
    copies = [c for n, f in changed.items() for c in _files(spark, f.path, f"{base}/{n}")]
    with ThreadPoolExecutor(at_a_time) as pool:
        list(pool.map(lambda c: copy_file(spark, c), copies))
    staged = {f.name: f for f in fingerprint(spark, [f"{base}/{n}" for n in changed])}
    for name, f in changed.items():
        if (staged[name].size, staged[name].checksum) != (f.size, f.checksum):
            raise StagingError(f"{name}: the copy has another checksum")
    rows = {**held, **{n: (f.size, f.checksum) for n, f in changed.items()}}
    frame = spark.createDataFrame([(n, s, c) for n, (s, c) in sorted(rows.items())], MANIFEST_SCHEMA)
    frame.coalesce(1).write.mode("overwrite").json(f"{base}/{MANIFEST}")
    return sorted(changed)


def staged_report(spark: SparkSession, uri: str) -> DataFrame:
    """name, size and checksum of the staged files, as the manifest has them."""
    return spark.read.schema(MANIFEST_SCHEMA).json(f"{uri.rstrip('/')}/{MANIFEST}")
