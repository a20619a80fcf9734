"""Line dedup by levelled sorted runs of line hashes.

Documents come in batches of ascending ids.  A run is a table of line-key
hashes, bucketed and sorted by hash; a batch merge-joins its own distinct
keys against the runs, drops the lines whose key a run holds, keeps a new
key's lines in the batch's smallest id only, and writes its new keys as a
run of level 0.  When a level holds ``FANOUT`` runs they are merged into one
run of the next level, so a batch meets a logarithmic number of runs and a
key is rewritten once a level.  As batches ascend, the first batch that
holds a key holds its smallest id.

A key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z
lower-cased; keys of at least ``MIN_CHARS`` code points count.  It is hashed
to 128 bits (two seeded 64-bit hashes).  A very frequent key is one row in
the aggregates (combined before the shuffle) and its lines meet it in a join
whose large partitions Spark splits.

Defined results: null or empty text is one empty line and stays; a null
``doc_id`` orders after all others; rows with equal ``doc_id`` are one
document (lines that only they share stay); equal rows get equal results;
other columns are kept.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LAST_ID, SPACE_CHARS, read_table, shared_path, stored

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), UPPER, UPPER.lower())


def _row_key() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("__d"), F.xxhash64(text).alias("__t")]


def document_lines(docs: DataFrame) -> DataFrame:
    """(__d, __t, pos, h1, h2): the lines of each row whose key is long enough."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n")
    each = docs.select(*_row_key(), F.posexplode(lines).alias("pos", "line"))
    keyed = each.select("__d", "__t", "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= MIN_CHARS)
    return keyed.select("__d", "__t", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """The levelled runs; ``add`` meets a batch with them and adds its run."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def _write(self, keys: DataFrame, level: int) -> DataFrame:
        path = shared_path(self.spark, f"line-run{level}")
        keys.select(*KEY).repartition(*KEY).sortWithinPartitions(*KEY).write.parquet(path)
        return self.spark.read.schema(keys.select(*KEY).schema).parquet(path)

    def add(self, lines: DataFrame) -> DataFrame:
        """(__d, __t, pos) of the batch's lines to drop."""
        met = lines.groupBy(*KEY).agg(F.min("__d").alias("first"), F.max("__d").alias("last"))
        known = F.lit(False)
        for k, run in enumerate(r for level in self.levels for r in level):
            met = met.join(run.withColumn(f"__r{k}", F.lit(True)), KEY, "left")
            known = known | F.col(f"__r{k}").isNotNull()
        met = stored(met.select(*KEY, "first", "last", known.alias("known")), "line-batch")
        fresh = met.where(~F.col("known"))
        # a key of an earlier batch loses all its lines, another one those after its first holder
        repeated = met.where(F.col("known") | (F.col("last") > F.col("first"))).select(
            *KEY, F.when(~F.col("known"), F.col("first")).alias("first"))
        gone = lines.join(repeated, KEY).where(F.col("first").isNull() | (F.col("__d") > F.col("first")))
        self._push(fresh, 0)
        return gone.select("__d", "__t", "pos")

    def _push(self, keys: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(self._write(keys, level))
        if len(self.levels[level]) > self.fanout:  # compact into the next level
            runs, self.levels[level] = self.levels[level], []
            merged = runs[0]
            for r in runs[1:]:
                merged = merged.unionByName(r)
            self._push(merged, level + 1)


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with ``text`` less its repeated lines, ``__n_lines`` and ``__n_dropped``."""
    spark = docs.sparkSession
    every = document_lines(docs)
    cuts = docs.agg(F.percentile_approx(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)), [k / batches for k in range(1, batches)], 1000)).first()[0]
    batch = F.lit(0)
    for cut in cuts or []:
        batch = batch + F.when(F.col("__d") > cut, 1).otherwise(0)
    lines = stored(every.withColumn("__batch", batch), "line-keys", "__batch")
    runs, gone = LineRuns(spark, fanout), None
    for k in range(batches):
        part = runs.add(lines.where(F.col("__batch") == k).drop("__batch"))
        gone = part if gone is None else gone.unionByName(part)
    dropped = gone.groupBy("__d", "__t").agg(F.collect_set("pos").alias("__gone"))
    own = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("__doc"), *_row_key())
    joined = rows.join(dropped, ["__d", "__t"], "left")
    text = F.coalesce(F.col("__doc.text"), F.lit(""))
    split = F.split(text, "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__gone"))
    less = F.get(F.transform(F.array(split), lambda s: F.array_join(F.transform(stay, lambda i: F.get(s, i)), "\n")), F.lit(0))
    return joined.select(
        *[F.col(f"__doc.`{c}`").alias(c) for c in own if c != "text"],
        F.when(F.col("__gone").isNull(), F.col("__doc.text")).otherwise(less).alias("text"),
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("__n_lines"),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias("__n_dropped"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of all ``documents``."""
    done = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return done.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), kept.alias("kept_sha256"))
