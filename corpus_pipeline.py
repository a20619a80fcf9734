"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and works on all rows its predecessor kept.  All but the last return the
columns of ``documents``.  Every stage is written as Parquet in the shared
folder and read again as the next one's input, so a lost executor repeats a
part of one stage.  Empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.common import read_table, stored
from shelfcast.llm.language_id import identify, train
from shelfcast.llm.line_dedup import dedup_lines
from shelfcast.llm.mixing import mix
from shelfcast.llm.near_dedup import classes
from shelfcast.llm.packing import VOCABULARY, pack
from shelfcast.plans.joins import small_side


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from these documents."""
    return identify(docs, train(docs)).where(~F.col("__lang.rejected")).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less the lines that an earlier document holds."""
    done = dedup_lines(docs)
    if "n_chars" in docs.columns:
        chars = F.when(F.col("__n_dropped") > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the smallest id."""
    return classes(docs).where("__kept").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Rows get a number as the stage's input is stored, so each has its own copies.
    """
    row, of, taken = (_free(name, docs) for name in ("__row", "__of", "__taken"))
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "pipeline-rows")
    mixed = mix(rows.select("doc_id", "text", "source", row), row).where("copies > 0")
    copies = stored(mixed.select(F.col(row).alias(of), F.col("copies").cast("int").alias(taken)), "pipeline-copies")
    repeated = rows.join(small_side(copies), F.col(row) == F.col(of))
    return repeated.withColumn(of, F.explode(F.array_repeat(F.lit(1), F.col(taken)))).select(*docs.columns)


def _free(name: str, docs: DataFrame) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None  # trained models, samplings and alignments: tested against brute force
