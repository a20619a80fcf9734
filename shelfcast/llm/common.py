"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# The white space of the word and line rules: space and U+0009 to U+000D.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_RUN = r"[ \t-\r]+"

BATCH_BYTES = 4 << 20  # of an Arrow batch, about
LAST_ID = 2**63 - 1  # stands for a null id wherever ids are ordered: last


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage: later jobs, and retries after a lost executor, read the
    files instead of computing ``df`` again.
    """
    path = shared_path(df.sparkSession, tag)
    with small_batches(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Queries run inside send Python batches of ``BATCH_BYTES``: the JVM and the worker each hold whole ones."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def word_array(text: Column) -> Column:
    """The ``[^\\x20\\x09-\\x0D]+`` words of a text (null: none)."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, SPACE_RUN))


def uniform(*key: Column, seed: int) -> Column:
    """A draw in [0, 1) fixed by the key: reruns and retries agree."""
    return F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1 << 53)) / F.lit(float(1 << 53))


def give_back() -> None:
    """Return this process's freed memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not the GNU C library
        pass


Batches = Iterator[pa.RecordBatch]


def giving_back(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInArrow; after its last batch the Python worker gives back what it freed.

    Workers live on between tasks, so what they hold would add up with the
    memory of the stages after it.
    """

    @wraps(run)
    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        give_back()

    return wrapped
