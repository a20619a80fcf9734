"""Token files: ids in Simple-8b words, written in document order.

Format.  A shard holds whole documents in a row (at least ``SHARD_IDS`` ids
but for the last of a partition).  Its ids are cut into blocks of ``BLOCK``
ids, and each block starts a new 64-bit word, so blocks decode on their own:

    header   <4sIIII   magic "S8B1", ids, words, blocks, escapes
    offsets  u4 x blocks   first word of each block
    words    u8 x words    selector in the top 4 bits, then values from the low bits up
    escapes  u8 x escapes  values of 60 bits or more, in order

Selectors 0 to 13 pack 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2 or 1
values of 60 // n bits; 14 packs 120 zeros; 15 holds an index into the
escapes.  The encoder takes at each place the selector that packs most.  Both
directions are vectorised: all blocks of a shard advance together, word by
word, when encoding, and all words of one selector unpack at once.

Shards are rows of a Parquet table in the shared folder, written by Spark's
committer (a lost executor leaves no half file): partition, ids before the
shard in its partition, document ids and lengths, and the shard itself.
Documents are range-partitioned and sorted by ``doc_id``.

Defined results: null or empty text has the end id only; a null ``doc_id``
comes first; rows with equal ``doc_id`` are ordered by text, and equal rows
are written each; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import small_side
from .common import read_table, shared_path, stored
from .wordcache import encoder

MAGIC = b"S8B1"
BLOCK = 1024
SHARD_IDS = 1_000_000
PER_WORD = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
ZEROS, ZERO_COUNT, ESCAPE = 14, 120, 15
_HEADER = struct.Struct("<4sIIII")
END_ID = 1
VOCABULARY = "word_bpe_49k.json"


def encode_shard(ids: np.ndarray) -> bytes:
    """The shard of unsigned 64-bit values."""
    ids = np.asarray(ids, np.uint64)
    blocks = -(-len(ids) // BLOCK)
    values = np.zeros((blocks, BLOCK), np.uint64)
    values.ravel()[: len(ids)] = ids
    room = np.full(blocks, BLOCK)
    if blocks:
        room[-1] = len(ids) - (blocks - 1) * BLOCK
    # The selector at each place, from one value a word to the most.
    escaped = values >= np.uint64(1 << 60)
    choice = np.full((blocks, BLOCK), 13, np.uint8)
    choice[escaped] = ESCAPE
    for sel in (*range(12, -1, -1), ZEROS):
        n = ZERO_COUNT if sel == ZEROS else PER_WORD[sel]
        bits = 0 if sel == ZEROS else 60 // n
        small = values < np.uint64(1 << bits)
        small[-1:, room[-1] if blocks else 0:] = True
        if small.sum() < n // 2:
            continue
        # Values past the block's end count as small: a last word may be part full.
        large = np.zeros((blocks, BLOCK + n + 1), np.int32)
        np.cumsum(~small, axis=1, out=large[:, 1: BLOCK + 1])
        large[:, BLOCK + 1:] = large[:, BLOCK: BLOCK + 1]
        fits = large[:, n: BLOCK + n] == large[:, :BLOCK]
        choice[fits] = sel
    step = np.array([*PER_WORD, ZERO_COUNT, 1])
    # All blocks walk on together, a word a round.
    at, live, rounds = np.zeros(blocks, np.int64), np.arange(blocks), []
    while len(live):
        sel = choice[live, at[live]]
        rounds.append((live, at[live], sel))
        at[live] += step[sel]
        live = live[at[live] < room[live]]
    block = np.concatenate([r[0] for r in rounds]) if rounds else np.zeros(0, np.int64)
    place = np.concatenate([r[1] for r in rounds]) if rounds else np.zeros(0, np.int64)
    sels = np.concatenate([r[2] for r in rounds]) if rounds else np.zeros(0, np.uint8)
    order = np.argsort(block, kind="stable")  # rounds of a block come in order
    block, place, sels = block[order], place[order], sels[order]
    words = sels.astype(np.uint64) << np.uint64(60)
    padded = np.zeros((blocks, BLOCK + 60), np.uint64)
    padded[:, :BLOCK] = values
    for sel, n in enumerate(PER_WORD):
        of = np.flatnonzero(sels == sel)
        if len(of):
            shift = (np.arange(n) * (60 // n)).astype(np.uint64)
            words[of] |= np.bitwise_or.reduce(padded[block[of][:, None], place[of][:, None] + np.arange(n)] << shift, axis=1)
    of = np.flatnonzero(sels == ESCAPE)
    words[of] |= np.arange(len(of), dtype=np.uint64)
    escapes = values[block[of], place[of]]
    offsets = np.searchsorted(block, np.arange(blocks)).astype("<u4")
    head = _HEADER.pack(MAGIC, len(ids), len(words), blocks, len(escapes))
    return b"".join((head, offsets.tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()))


def decode_shard(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The values of a shard, or of its blocks ``first`` to ``last`` (exclusive)."""
    magic, n_ids, n_words, blocks, n_escapes = _HEADER.unpack_from(data)
    if magic != MAGIC:
        raise ValueError("not a Simple-8b shard")
    at = _HEADER.size
    offsets = np.frombuffer(data, "<u4", blocks, at).astype(np.int64)
    words = np.frombuffer(data, "<u8", n_words, at + 4 * blocks)
    escapes = np.frombuffer(data, "<u8", n_escapes, at + 4 * blocks + 8 * n_words)
    last = blocks if last is None else min(last, blocks)
    if first >= last:
        return np.zeros(0, np.uint64)
    begin, end = offsets[first], offsets[last] if last < blocks else n_words
    words, starts = words[begin:end], offsets[first:last] - begin
    sels = (words >> np.uint64(60)).astype(np.int64)
    count = np.array([*PER_WORD, ZERO_COUNT, 1])[sels]
    total = np.cumsum(count) - count
    lengths = np.diff(np.append(starts, len(words)))
    place = total - np.repeat(total[starts], lengths)  # of a word's first value, in its block
    row = np.repeat(np.arange(last - first), lengths)
    out = np.zeros((last - first, BLOCK + ZERO_COUNT), np.uint64)
    for sel, n in enumerate(PER_WORD):
        of = np.flatnonzero(sels == sel)
        if len(of):
            bits = 60 // n
            shift = (np.arange(n) * bits).astype(np.uint64)
            out[row[of][:, None], place[of][:, None] + np.arange(n)] = (words[of][:, None] >> shift) & np.uint64((1 << bits) - 1)
    of = np.flatnonzero(sels == ESCAPE)
    out[row[of], place[of]] = escapes[(words[of] & np.uint64((1 << 60) - 1)).astype(np.int64)]
    return out[:, :BLOCK].ravel()[: min(n_ids, last * BLOCK) - first * BLOCK]


SHARD_SCHEMA = "part int, before long, doc_ids array<long>, lengths array<long>, shard binary"
_ARROW = pa.schema([
    ("part", pa.int32()), ("before", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
    ("shard", pa.binary()),
])


def write_token_files(docs: DataFrame, vocabulary: str, path: str, lower: bool = True, end_id: int = END_ID,
                      partitions: int | None = None) -> None:
    """Encode ``docs`` in ascending ``doc_id`` order and write their shards at ``path``."""
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(
        n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, before = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        ids: list[np.ndarray] = []
        held = 0
        end = np.array([end_id], np.uint16)

        def close() -> pa.RecordBatch:
            nonlocal before, held
            lengths = [len(x) for x in ids]
            row = pa.RecordBatch.from_pylist([{
                "part": part, "before": before, "doc_ids": doc_ids, "lengths": lengths, "shard": encode_shard(np.concatenate(ids)),
            }], schema=_ARROW)
            before += held
            doc_ids.clear()
            ids.clear()
            held = 0
            return row

        for b in batches:
            for doc_id, x in zip(b["doc_id"].to_pylist(), encoder(vocabulary, lower).encode(b["text"].to_pylist()), strict=True):
                doc_ids.append(doc_id)
                ids.append(np.concatenate([x, end]))
                held += len(x) + 1
                if held >= SHARD_IDS:
                    yield close()
        if ids:
            yield close()

    ordered.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the files at ``path``."""
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    ids = shards.select("part", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    parts = ids.groupBy("part").agg(F.sum("n").alias("n"))  # one row a file partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(F.col("part").alias("__part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    parts = stored(parts, "token-parts")  # its real size decides whether it is broadcast
    placed = shards.join(small_side(parts), F.col("part") == F.col("__part")).select(
        (F.col("__before") + F.col("before")).alias("start"), "doc_ids", "lengths", "shard")

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = decode_shard(row["shard"]).astype("<u4")
                length = np.array(row["lengths"], np.int64)
                ends = np.cumsum(length)
                crc = [zlib.crc32(ids[e - n: e].tobytes()) for e, n in zip(ends, length, strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - length),
                    pa.array(length), pa.array(crc, pa.int64()),
                ], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, encoded, written and read back."""
    import public_tokenizers

    path = shared_path(spark, "token-files")
    write_token_files(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), path)
    return read_token_files(spark, path)
