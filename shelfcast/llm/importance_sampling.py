"""Importance resampling towards a target distribution of hashed n-grams.

Features of a text are its runs of 1 to 3 consecutive words, hashed into
``BUCKETS`` buckets; a bucket's gain is the log ratio of its share in the
target to its share in the documents, in thousandths.  A document's weight is
the sum of its features' gains; adding a Gumbel draw fixed by its id and
keeping the highest scores draws documents without replacement with
probabilities in proportion to the exponential of their weights.

Two passes read the documents.  Both intern the n-grams of a slice in an
open-addressed NumPy table (``GramTable``): xxhash64 keys with linear
probing, a hit verified byte by byte.  A slot stores its n-gram's bucket and
number of occurrences; crc32 is taken of the slice's distinct words and
joined for the slots' n-grams.  The first pass sums counts by bucket (at most ``BUCKETS`` rows a
task); the second gathers the gains of the occurrences' slots and sums them
by document.  What goes through the driver is one number for each bucket.
The draw ranks rows by a range-partitioned sort, all rows on their
fixed-width columns only.

Slices hold about ``SLICE_BYTES`` of text; the n-grams of a longer text are
interned in blocks of ``BLOCK_WORDS`` words, so that a table stays bounded.
Memory is a small multiple of the longest text.

Defined results: null and empty texts have no features, weight 0 and are
never drawn; a null id draws as the empty string and comes last among equal
scores; rows with equal ids are drawn each on its own, rows equal in score
and id in any order; other columns are ignored.  An empty table of documents
gives an empty result; an empty target gives gains from the documents alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.features import global_rank
from .common import read_table, stored
from .hashing import Crc, Lanes, crc32, xxh64
from .lexis import Words, slices, split_words

BUCKETS = 10_000
GRAMS = (1, 2, 3)
MIN_WORDS = 20
DRAWN_PERCENT = 5
SEED = 42
BLOCK_WORDS = 100_000
CRC = Crc()


class GramTable:
    """Distinct byte slices of one buffer, in open addressing.

    A slot names the occurrence that took it (its ``key``, start and length
    identify the n-gram) and stores the n-gram's ``bucket`` and ``count``.
    The capacity is at least twice the number of occurrences to come, so
    probing ends.
    """

    def __init__(self, lanes: Lanes, start: np.ndarray, length: np.ndarray, key: np.ndarray | None = None) -> None:
        self.lanes, self.start, self.length = lanes, start, length
        self.key = xxh64(lanes, start, length) if key is None else key
        size = 1 << max(4, (2 * len(start) - 1).bit_length())
        self.owner = np.full(size, -1, np.int32)
        self.slot = self._intern()
        self.used = np.flatnonzero(self.owner >= 0)
        self.count = np.bincount(self.slot, minlength=size)
        self.bucket = np.zeros(size, np.int64)

    def _intern(self) -> np.ndarray:
        """The slot of each occurrence; new n-grams take free slots."""
        mask = len(self.owner) - 1
        slot = np.zeros(len(self.start), np.int64)
        todo = np.arange(len(self.start))
        at = (self.key & np.uint64(mask)).astype(np.int64)
        while len(todo):
            held = self.owner[at]
            free = held < 0
            self.owner[at[free]] = todo[free]  # of those that claim a slot one stays
            held[free] = self.owner[at[free]]
            hit = (self.key[held] == self.key[todo]) & (self.length[held] == self.length[todo])
            close = np.flatnonzero(hit)
            a, b = held[close], todo[close]
            hit[close] = self.lanes.equal(self.start[a], self.start[b], self.length[b])
            slot[todo[hit]] = at[hit]
            todo, at = todo[~hit], (at[~hit] + 1) & mask
        return slot


def gram_blocks(words: Words, block_words: int = BLOCK_WORDS) -> Iterator[tuple[GramTable, list[tuple[np.ndarray, np.ndarray]]]]:
    """Blocks of n-grams by their first words: a table, and for each n the
    first words' numbers and the occurrences' slots."""
    n_words = len(words.start)
    if not n_words:
        return
    end = words.start + words.length
    last = np.repeat(words.first[1:], words.per_text)  # one past the last word of the text
    coded = words.array().dictionary_encode()
    code, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    alone, spaced = crc32(distinct)[code], crc32([b" " + w for w in distinct])[code]
    for a in range(0, n_words, block_words):
        b = min(a + block_words, n_words)
        base = words.start[a]
        tail = end[min(b + GRAMS[-1] - 1, n_words) - 1] - base
        lanes = Lanes(np.concatenate([words.buf[base: base + tail], np.zeros(8, np.uint8)]))
        block = np.arange(a, b)
        heads = [block[block + n <= last[a:b]] for n in GRAMS]
        cuts = np.cumsum([len(h) for h in heads])[:-1]
        first = np.concatenate(heads)
        length = np.concatenate([end[h + n - 1] for h, n in zip(heads, GRAMS, strict=True)]) - words.start[first]
        table = GramTable(lanes, words.start[first] - base, length)
        # A slot's bucket, from the values of its n-gram's words.
        owner = table.owner[table.used]
        word, size = first[owner], np.searchsorted(cuts, owner, "right") + 1
        crc = alone[word]
        for n in GRAMS[1:]:
            more = np.flatnonzero(size >= n)
            then = word[more] + n - 1
            crc[more] = CRC.join(crc[more], spaced[then], words.length[then] + 1)
        table.bucket[table.used] = crc % BUCKETS
        yield table, list(zip(heads, np.split(table.slot, cuts), strict=True))


def _count_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for part in slices(batches):
        for table, _ in gram_blocks(split_words(part.column("text"))):
            total += np.bincount(table.bucket[table.used], table.count[table.used], BUCKETS).astype(np.int64)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Occurrences of all features of ``text``, by bucket."""
    parts = texts.select("text").mapInArrow(_count_buckets, "bucket long, n long")
    counts = np.zeros(BUCKETS, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        counts[row.bucket] = row.n
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, target to source."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weights(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """``doc_id``, n_words, n_features and weight of each row."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"))
            weight = np.zeros(part.num_rows, np.int64)
            features = np.zeros(part.num_rows, np.int64)
            of = np.repeat(np.arange(part.num_rows), words.per_text)
            for table, grams in gram_blocks(words):
                gain = gains[table.bucket]
                for head, slot in grams:
                    # Occurrences come in the order of texts: sums are differences of running sums.
                    run = np.concatenate([[0], np.cumsum(gain[slot])])
                    doc, begin = np.unique(of[head], return_index=True)
                    weight[doc] += np.diff(run[np.append(begin, len(head))])
                    features[doc] += np.diff(np.append(begin, len(head)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(words.per_text.astype(np.int64)), pa.array(features), pa.array(weight)],
                ["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: F.Column, seed: int = SEED) -> F.Column:
    """floor(1000 x) of a Gumbel draw x fixed by the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, seed: int = SEED) -> DataFrame:
    """``doc_id``, n_words, n_features, weight, score and rank (null: not drawn)."""
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    scored = stored(
        weights(docs, gains).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance-scores")
    rows, long_enough = scored.agg(F.count("*"), F.count(F.when(F.col("n_words") >= MIN_WORDS, 1))).first()
    order = {
        "__out": F.col("n_words") < MIN_WORDS,
        "__low": -F.col("score"),
        "__no_id": F.col("doc_id").isNull(),
        "__id": F.col("doc_id"),
        "__row": F.monotonically_increasing_id(),  # splits equal rows among tasks
    }
    ranked = global_rank(scored.select("*", *[c.alias(n) for n, c in order.items()]), list(order), rows)
    drawn = ~F.col("__out") & (F.col("__rn") <= F.lit(percent * long_enough // 100))
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", F.when(drawn, F.col("__rn")).alias("rank"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents drawn towards the distribution of the benchmark texts."""
    drawn = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
