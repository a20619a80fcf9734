"""Packing with a controlled mixture: deficit round-robin over source queues.

Documents are encoded where they are read and written with the running sum of
their source's ids.  A document's place in its source's ids, as a share of
them, says its chunk: each of the ``all ids / CHUNK_IDS`` chunks takes the same
range of every source (whole documents), so it holds all sources at their
shares, up to a document a source, however the input is clustered.  A chunk is
then packed on
its own: its documents wait in one queue a source, and windows of
``WINDOW_SEQUENCES`` sequences are filled by deficit round-robin.  In a
round every waiting source earns its target share of the room left in the
window and hands over as many ids as its deficit allows, cutting a document
where the deficit or the window ends; the rest of the deficit is carried to
the next window.  A source whose queue is empty earns nothing, and the
others fill its place, so the end of a chunk is what its documents exceed the
shares by.  The stream is cut every ``LENGTH`` ids, so only the last sequence
of a chunk is padded: one a table up to 1.5 ``CHUNK_IDS``, else at most one in
``CHUNK_IDS / LENGTH / 1.5`` or so, whatever the input's partitions.

Between chunks the deficits are carried by running sums: a
source starts a chunk with its share of all ids before the chunk less its
own ids before it.  Targets are the sources' shares of all ids, so that
every queue lasts; other targets may be given.

Defined results: null or empty text has the end id only; a null source is a
queue like any other; repeated rows are packed each; other columns are
ignored; an empty table gives an empty result.  Which documents share a
chunk follows the input's order; a source of few documents, or one longer than
a chunk, isn't in every chunk.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.joins import small_side
from .common import giving_back, read_table, shared_path, small_batches, stored, uniform
from .lexis import slices
from .wordcache import encoder

LENGTH = 2048
WINDOW_SEQUENCES = 16
CHUNK_IDS = 2_000_000
SLICE_BYTES = 1_000_000  # of text, encoded at a time
SEED = 10
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"

ENCODED_SCHEMA = "part long, row long, doc_id long, source string, before long, n long, ids binary"
PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
)

Piece = tuple[int, int, int]  # document in the chunk, first id, ids


def round_robin(sources: list[str | None], lengths: list[int], shares: dict[str | None, float],
                carried: dict[str | None, float], window: int) -> list[Piece]:
    """The chunk's ids in packed order."""
    queues: dict[str | None, deque[int]] = {}
    for doc, source in enumerate(sources):
        queues.setdefault(source, deque()).append(doc)
    waiting = sorted(queues, key=lambda s: (s is None, s or ""))
    deficit = {s: carried.get(s, 0.0) for s in waiting}
    given = [0] * len(lengths)  # ids of each document handed over
    out: list[Piece] = []
    while waiting:
        room = window
        while room and waiting:
            whole = sum(shares.get(s, 0.0) for s in waiting)
            quantum = {s: (shares.get(s, 0.0) / whole if whole else 1 / len(waiting)) * room for s in waiting}
            before = room
            for s in waiting:
                deficit[s] += quantum[s]
                take = min(room, int(deficit[s]))
                queue = queues[s]
                while take > 0 and queue:
                    doc = queue[0]
                    n = min(take, lengths[doc] - given[doc])
                    out.append((doc, given[doc], n))
                    given[doc] += n
                    deficit[s] -= n
                    room -= n
                    take -= n
                    if given[doc] == lengths[doc]:
                        queue.popleft()
            waiting = [s for s in waiting if queues[s]]
            if room == before and waiting:  # every deficit is below one id: lift the one nearest to it
                best = max(waiting, key=lambda s: deficit[s])
                lift = 1.0 - deficit[best]
                for s in waiting:
                    deficit[s] += lift
    return out


def sequences(pieces: list[Piece], length: int) -> list[tuple[int, int, int, int, int]]:
    """(document, first id, ids, sequence, offset): the stream cut every ``length`` ids."""
    out: list[tuple[int, int, int, int, int]] = []
    at = 0
    for doc, start, n in pieces:
        while n:
            seq, offset = divmod(at, length)
            k = min(n, length - offset)
            last = out[-1] if out else None
            if last and last[0] == doc and last[3] == seq and last[1] + last[2] == start:
                out[-1] = (doc, last[1], last[2] + k, seq, last[4])
            else:
                out.append((doc, start, k, seq, offset))
            at, start, n = at + k, start + k, n - k
    return out


def encoded(batches: Iterator[pa.RecordBatch], vocabulary: str, part: int, end_id: int = END_ID) -> Iterator[pa.RecordBatch]:
    """The ids of a partition's documents, about ``SLICE_BYTES`` of text at a time."""
    row = 0
    so_far: dict[str | None, int] = {}
    end = np.array([end_id], np.uint16)
    for b in slices(batches, limit=SLICE_BYTES):
        texts = encoder(vocabulary, False).encode(b["text"].to_pylist())
        before, n = [], []
        for source, x in zip(b["source"].to_pylist(), texts, strict=True):
            n.append(len(x) + 1)
            before.append(so_far.get(source, 0))
            so_far[source] = before[-1] + n[-1]
        ids = [np.concatenate([x, end]).astype("<u2").tobytes() for x in texts]
        rows = range(row, row + b.num_rows)
        row += b.num_rows
        yield pa.RecordBatch.from_arrays([
            pa.array([part] * b.num_rows, pa.int64()), pa.array(rows, pa.int64()), b["doc_id"], b["source"],
            pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary()),
        ], names=[f.split()[0] for f in ENCODED_SCHEMA.split(", ")])


def write_encoded(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID) -> None:
    """Encode ``docs`` (doc_id, text, source) at ``path``; ``before`` counts the source's ids earlier in the partition."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        return encoded(batches, vocabulary, TaskContext.get().partitionId(), end_id)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("source").cast("string").alias("source"))
    with small_batches(docs.sparkSession):
        plain.mapInArrow(giving_back(encode), ENCODED_SCHEMA).write.option("compression", "zstd").parquet(path)


def dealt(encoded: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """``encoded`` with ``chunk``: equal ranges of each source's ids."""
    own = stored(encoded.groupBy("part", "source").agg(F.sum("n").alias("own")), "pack-parts")
    chunks = max(1, round((own.agg(F.sum("own")).first()[0] or 0) / chunk_ids))
    by_source = Window.partitionBy("source")  # one row an input partition
    earlier = by_source.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = stored(own.select(
        F.col("part").alias("__p"), F.col("source").alias("__s"), F.sum("own").over(by_source).alias("__all"),
        F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("__before")), "pack-places")
    # Each source's range begins at a place of its own: else the first documents of
    # all sources, however many there are, would meet in the first chunk.
    turn = uniform(F.col("source"), seed=SEED)
    at = F.pmod((F.col("__before") + F.col("before")) / F.col("__all") + turn, F.lit(1.0))
    joined = encoded.join(small_side(places), (F.col("part") == F.col("__p")) & F.col("source").eqNullSafe(F.col("__s")))
    return joined.withColumn("chunk", F.least(F.floor(at * chunks), F.lit(chunks - 1)).cast("long")).drop("__p", "__s", "__all", "__before")


def chunk_shares(documents: DataFrame, targets: DataFrame | None = None) -> DataFrame:
    """(chunk, queue): for each source of a chunk its share and the deficit it starts with.

    ``documents`` has (chunk, source, n); ``targets`` (source, share) replaces
    the sources' shares of all ids.
    """
    own = stored(documents.groupBy("chunk", "source").agg(F.sum("n").alias("n")), "pack-counts")
    if targets is None:
        by_source = own.groupBy("source").agg(F.sum("n").alias("n"))
        everything = own.agg(F.sum("n").alias("all"))
        targets = by_source.crossJoin(F.broadcast(everything)).select("source", (F.col("n") / F.col("all")).alias("share"))
    before = (Window.unboundedPreceding, -1)
    whole = own.groupBy("chunk").agg(F.sum("n").alias("n"))  # one row a chunk
    whole = whole.select(F.col("chunk").alias("__c"), F.coalesce(
        F.sum("n").over(Window.orderBy("chunk").rowsBetween(*before)), F.lit(0)).alias("all_before"))
    # A source absent from a chunk has no ids in it, so its running sum needs no row there.
    summed = own.withColumn("own_before", F.coalesce(
        F.sum("n").over(Window.partitionBy("source").orderBy("chunk").rowsBetween(*before)), F.lit(0)))
    t = targets.select(F.col("source").alias("__t"), "share")
    counted = summed.join(small_side(whole), F.col("chunk") == F.col("__c")).join(
        small_side(t), F.col("source").eqNullSafe(F.col("__t")), "left")
    share = F.coalesce("share", F.lit(0.0))
    entry = F.struct("source", share.alias("share"), (share * F.col("all_before") - F.col("own_before")).alias("deficit"))
    return counted.groupBy("chunk").agg(F.collect_list(entry).alias("queues"))


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, window_sequences: int = WINDOW_SEQUENCES,
         chunk_ids: int = CHUNK_IDS, targets: DataFrame | None = None) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text, source)."""
    spark = docs.sparkSession
    path = shared_path(spark, "pack-encoded")
    write_encoded(docs, vocabulary, path)
    documents = dealt(spark.read.schema(ENCODED_SCHEMA).parquet(path), chunk_ids)
    shares = stored(chunk_shares(documents.select("chunk", "source", "n"), targets), "pack-shares").withColumnRenamed("chunk", "__chunk")
    doc = F.struct("part", "row", "doc_id", "source", "n", "ids")
    chunks = documents.repartition("chunk").groupBy("chunk").agg(F.sort_array(F.collect_list(doc)).alias("docs"))
    ready = chunks.join(small_side(shares), F.col("chunk") == F.col("__chunk")).select("chunk", "docs", "queues")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                chunk, queues = b["chunk"][i].as_py(), b["queues"][i].as_py()
                _, _, doc_ids, sources, lengths, ids = (x.to_pylist() for x in b["docs"][i].values.flatten())
                ids = memoryview(np.frombuffer(b"".join(ids), "<u2").astype("<u4").tobytes())
                shares = {q["source"]: q["share"] for q in queues}
                carried = {q["source"]: q["deficit"] for q in queues}
                order = round_robin(sources, lengths, shares, carried, length * window_sequences)
                cut = sequences(order, length)
                first = np.cumsum([0, *lengths])
                crc = [zlib.crc32(ids[4 * (first[d] + s): 4 * (first[d] + s + n)]) for d, s, n, _, _ in cut]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc_ids[c[0]] for c in cut], pa.int64()),
                    pa.array([c[1] for c in cut], pa.int64()), pa.array([c[2] for c in cut], pa.int64()),
                    pa.array(crc, pa.int64()), pa.array([lengths[c[0]] for c in cut], pa.int64()),
                    pa.array([(chunk << 20) + c[3] for c in cut], pa.int64()),
                    pa.array([c[4] for c in cut], pa.int64()),
                    pa.array([sources[c[0]] for c in cut], pa.string()),
                ], names=[f.split()[0] for f in PIECE_SCHEMA.split(", ")])

    return ready.mapInArrow(giving_back(pieces), PIECE_SCHEMA)


def op10_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``, packed."""
    import public_tokenizers

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
