"""Removal of repeated passages by column-wise Burrows-Wheeler construction.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts
anywhere else in the documents, the same one included.

Candidates.  Out of every ``WINDOW`` neighbouring ``CORE``-byte strings the
one of least hash is an anchor.  Every ``LENGTH``-byte string holds an
anchor, chosen by its own bytes alone, so equal strings hold equal anchors at
the same place.  An anchor's context is what all such strings around it
cover.  Anchors that occur once are done; contexts that are equal as a whole
are repeated as a whole.  Differing contexts of an anchor are cut into parts
of ``STEP`` string starts each; a part whose common bytes occur once is done,
parts that are equal as a whole are repeated as a whole, and either kind
stands for its equals from there on.

Construction.  The differing parts with the same common bytes go to a
collection of bounded size.  Its Burrows-Wheeler transform is built column by column: each
round inserts one symbol per part, at the place given by the symbol's
rank in the transform so far, and rewrites the transform in one sequential
pass.  The common bytes of a part are one symbol, so a part has fewer than
``2 * STEP`` columns.  Neighbours in the final order whose common prefix has
``LENGTH`` bytes are repeated strings; the prefixes are taken from the
finished order.  The
sequential files are arrays of the task that holds the collection, since a
collection is bounded and a task's disk is not shared.  Common bytes with
more than ``GROUP`` differing parts (the edge of a passage in very many
documents) take another exact way: their strings are counted by digest.

Strings are judged on the input.  Defined results: null or empty text has 0
bytes and an empty rest; rows with equal ``doc_id`` are told apart by their
text, and equal rows are copies of each other (all their strings repeat);
other columns are ignored; an empty table gives an empty result.  Digests of
128 bits stand for equal bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import estimated_bytes, small_side
from .common import LAST_ID, read_table, stored

LENGTH = 400
CORE = 200
WINDOW = LENGTH - CORE + 1
STEP = 29
GROUP = 1000
COLLECTION = 1000
BROADCAST_BYTES = 8 << 20
FILTER_BITS = 1 << 26
ANCHOR_ROWS = 10_000
KEPT_POWERS = 1 << 16

_TABLE = np.random.default_rng(5).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers_below(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``2**bits`` powers of the base and of its inverse modulo 2**64."""
    up = np.full(1 << bits, _BASE, np.uint64)
    down = np.full(1 << bits, pow(_BASE, -1, 2**64), np.uint64)
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``n`` powers of the base and of its inverse; kept for short texts."""
    find = _powers_below if n <= KEPT_POWERS else _powers_below.__wrapped__
    return find(n.bit_length())


def _slide(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over every ``width`` neighbours, by doubling."""
    span, out = 1, x
    while span * 2 <= width:
        out = best(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return best(out[:-rest], out[rest:]) if rest else out


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the anchors of a text of at least ``LENGTH`` bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], dtype=np.uint64, out=sums[1:])
    h = (sums[CORE:] - sums[:-CORE]) * down[: len(data) - CORE + 1]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    least = _slide(h, WINDOW, np.minimum)  # of each window of cores
    edge = np.zeros(WINDOW - 1, np.uint64)
    most = _slide(np.concatenate([edge, least, edge]), WINDOW, np.maximum)  # of the windows around each core
    places = np.flatnonzero(h == most)
    return places, h[places]


def _small(df: DataFrame) -> DataFrame:
    """Broadcast a written table of at most ``BROADCAST_BYTES``: in memory it is several times as large."""
    return small_side(df, BROADCAST_BYTES)


def _held(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` with ``__may``, false only for rows whose (d, t) is none of the (__d, __t) of ``keys``.

    Keeps the texts of other documents out of a shuffle join.  The filter has a
    bit for each hash and at most ``FILTER_BITS``; with more keys than that it
    lets most rows through.  Keys that are broadcast themselves need none.
    """
    size = estimated_bytes(keys)
    if size is not None and size <= BROADCAST_BYTES:
        return docs.withColumn("__may", F.lit(True))

    def bit(*key: str) -> Column:
        return F.pmod(F.xxhash64(*key), F.lit(FILTER_BITS)) + 1

    bits = keys.select(bit("__d", "__t").alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("__bits"))
    bits = F.broadcast(stored(bits, "passage-filter"))
    at = F.bitmap_bit_position(bit("d", "t"))
    byte = F.conv(F.hex(F.substring("__bits", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    rows = docs.join(bits, F.bitmap_bucket_number(bit("d", "t")) == F.col("__bucket"), "left")
    return rows.withColumn("__may", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("__bucket", "__bits")


def _holding(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose (d, t) may be among the (__d, __t) of ``keys``."""
    return _held(docs, keys).where("__may").drop("__may")


def merged(ranges: Column) -> Column:
    """An array of (a, b) ranges as sorted ranges that neither overlap nor touch."""

    def add(done: Column, r: Column) -> Column:
        last = F.get(done, F.size(done) - 1)  # null at the start
        wider = F.struct(last["a"].alias("a"), F.greatest(last["b"], r["b"]).alias("b"))
        return F.when(r["a"] <= last["b"], F.concat(F.slice(done, 1, F.size(done) - 1), F.array(wider))).otherwise(
            F.concat(done, F.array(F.struct(r["a"].alias("a"), r["b"].alias("b")))))

    return F.aggregate(F.sort_array(ranges), F.array().cast("array<struct<a:int,b:int>>"), add)


def anchor_table(docs: DataFrame) -> DataFrame:
    """(key, digest, d, t, start, size, left) of every anchor: its hash, its
    context's digest, place and size, and the anchor's place in it."""

    names = ["key", "digest", "d", "t", "start", "size", "left"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[pa.RecordBatch] = []
        rows = 0
        for b in batches:
            for d, t, text in zip(*(b[c].to_pylist() for c in ("d", "t")), b["text"], strict=True):
                data = (text.as_py() or "").encode("utf-8")
                if len(data) < LENGTH:
                    continue
                places, keys = anchors(np.frombuffer(data, np.uint8))
                start = np.maximum(places - (LENGTH - CORE), 0)
                end = np.minimum(places + LENGTH, len(data))
                left = places - start
                digest = [
                    hashlib.blake2b(data[s:e], digest_size=16, salt=int(x).to_bytes(8, "little")).digest()
                    for s, e, x in zip(start.tolist(), end.tolist(), left.tolist(), strict=True)
                ]
                n = len(places)
                found.append(pa.RecordBatch.from_arrays([
                    pa.array(keys.view(np.int64)), pa.array(digest, pa.binary()), pa.array(np.full(n, d)),
                    pa.array(np.full(n, t)), pa.array(start.astype(np.int32)),
                    pa.array((end - start).astype(np.int32)), pa.array(left.astype(np.int32)),
                ], names=names))
                rows += n
                if rows >= ANCHOR_ROWS:  # one batch of many documents: each has a few anchors
                    yield pa.concat_batches(found)
                    found, rows = [], 0
        if found:
            yield pa.concat_batches(found)

    return docs.select("d", "t", "text").mapInArrow(
        find, "key long, digest binary, d long, t long, start int, size int, left int")


# -- construction ---------------------------------------------------------


def _rank(bwt: np.ndarray, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
    """How often each symbol stands before its place: its places in order, looked up."""
    n = len(bwt) + 1
    order = np.argsort(bwt, kind="stable")  # by radix for symbols of 16 bits
    places = bwt[order].astype(np.int64) * n + order
    own = symbol.astype(np.int64) * n
    return np.searchsorted(places, own + place) - np.searchsorted(places, own)


def suffix_order(segments: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start) of all non-empty suffixes in sorted order, by columns.

    ``bwt`` holds, in the order of the suffixes inserted so far, the symbol
    in front of each (0 where none is known yet), symbols numbered from 1 in their order.
    Round j puts the j-th last symbol of every segment in front of its latest
    suffix and inserts the suffix that starts with it.
    """
    m = len(segments)
    sizes = np.array([len(s) for s in segments])
    longest = int(sizes.max(initial=0))
    used, codes = np.unique(np.concatenate([*segments, np.zeros(0, np.int64)]), return_inverse=True)
    symbols = len(used) + 1
    kind = np.uint8 if symbols <= 1 << 8 else np.uint16 if symbols <= 1 << 16 else np.int32
    columns = np.zeros((longest, m), kind)
    end = np.cumsum(sizes)
    for i, e in enumerate(end):
        columns[: sizes[i], i] = codes[e - sizes[i]: e][::-1] + 1
    bwt = np.zeros(m, kind)  # the empty suffixes, in the segments' order
    at = np.arange(m)
    live = np.arange(m)
    count = np.zeros(symbols, np.int64)
    for j in range(longest):
        live = live[sizes[live] > j]
        symbol = columns[j, live]
        bwt[at[live]] = symbol
        count += np.bincount(symbol, minlength=symbols)
        first = m + np.cumsum(count) - count  # the first suffix of each symbol, after the empty ones
        new = first[symbol] + _rank(bwt, symbol, at[live])
        at[live] = new
        old = np.ones(len(bwt) + len(live), bool)
        old[new] = False
        grown = np.zeros(len(old), kind)
        grown[old] = bwt  # one sequential pass
        bwt = grown
    # Walk all segments through the finished transform, column by column.
    order = np.argsort(bwt, kind="stable")
    ends = int((bwt == 0).sum())  # whole segments have no symbol in front
    step = np.empty(len(bwt), np.int64)
    step[order] = np.arange(len(bwt)) - ends + m
    segment, start = np.full(len(bwt), -1), np.zeros(len(bwt), np.int64)
    place, live = np.arange(m), np.arange(m)
    for j in range(longest):
        keep = sizes[live] > j
        live, place = live[keep], place[keep]
        place = step[place]
        segment[place], start[place] = live, sizes[live] - j - 1
    return segment[m:], start[m:]


def repeated_starts(segments: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, start) of the strings of ``length`` symbols that occur twice or more."""
    segment, start = suffix_order(segments)
    sizes = np.array([len(s) for s in segments])
    long = sizes[segment] - start >= length
    segment, start = segment[long], start[long]
    if not len(segment):
        return segment, start
    begin = (np.cumsum(sizes) - sizes)[segment] + start
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate(segments), length)
    same = np.zeros(len(segment) + 1, bool)  # has ``length`` symbols in common with the one before
    same[1:-1] = (view[begin[1:]] == view[begin[:-1]]).all(axis=1)
    many = same[:-1] | same[1:]
    return segment[many], start[many]


def _spans(segment: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, a, b): merged [start, start + length) of each segment, of sorted (segment, start)."""
    head = np.ones(len(start), bool)
    head[1:] = (segment[1:] != segment[:-1]) | (np.diff(start) > length)
    first = np.flatnonzero(head)
    last = np.append(first[1:], len(start))[: len(first)] - 1
    return segment[first], start[first], start[last] + length


_FOUND = "core long, part binary, a int, b int"


def _collection(rows: pd.DataFrame) -> pd.DataFrame:
    """Repeated strings of the parts of some cores.

    A part is its bytes before the core, one symbol for the core and its
    bytes behind it; a string of ``LENGTH`` bytes is one of ``STEP`` symbols.
    """
    core = np.unique(rows["core"].to_numpy(), return_inverse=True)[1] + 256
    segments = [
        np.concatenate([np.frombuffer(x[:n], np.uint8), [c], np.frombuffer(x[n:], np.uint8)]).astype(np.int64)
        for x, n, c in zip(rows["edges"], rows["left"], core, strict=True)
    ]
    segment, start = repeated_starts(segments, STEP)
    order = np.lexsort((start, segment))
    s, a, b = _spans(segment[order], start[order], LENGTH)
    return pd.DataFrame({"core": rows["core"].to_numpy()[s], "part": rows["part"].to_numpy()[s], "a": a, "b": b})


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, part, at, start, string): the bytes around the core of every string of a part."""
    for b in batches:
        rows = []
        for i in range(b.num_rows):
            x, left, core, part = (b[c][i].as_py() for c in ("edges", "left", "core", "part"))
            rows += [(core, part, s - left, s, x[s: s + STEP - 1]) for s in range(len(x) - STEP + 2)]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["core", "part", "at", "start", "string"])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(core, part, member, a, size, left) of the contexts' parts.

    A part covers the strings that start on ``STEP`` neighbouring places,
    counted from the anchor; ``core`` is a hash of the bytes that all of
    them hold, with the anchor and the place, ``part`` a digest of the part.
    """
    for b in batches:
        rows: list[tuple[int, bytes, int, int, int, int]] = []
        for i in range(b.num_rows):
            data = b["text"][i].as_py().encode("utf-8")
            for m in b["members"][i].as_py():
                context = data[m["start"]: m["start"] + m["size"]]
                salt = (m["key"] % 2**64).to_bytes(8, "little")
                for first in range(CORE - LENGTH, 1, STEP):
                    a = max(first + m["left"], 0)
                    last = min(first + STEP - 1, 0) + m["left"]
                    last = min(last, len(context) - LENGTH)
                    if last < a:
                        continue
                    at = first + STEP - 1 + m["left"]  # where the common bytes start
                    core = hashlib.blake2b(
                        context[at: first + m["left"] + LENGTH], digest_size=8, salt=salt, person=(first + LENGTH).to_bytes(2, "little"))
                    part = context[a: last + LENGTH]
                    rows.append((
                        int.from_bytes(core.digest(), "little", signed=True),
                        hashlib.blake2b(part, digest_size=16, salt=(at - a).to_bytes(2, "little")).digest(),
                        m["member"], a, len(part), at - a))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
            names=["core", "part", "member", "a", "size", "left"])


def repeated_spans(docs: DataFrame, group: int = GROUP, collection: int = COLLECTION) -> DataFrame:
    """(d, t, spans): the repeated byte ranges of each row of (d, t, text)."""
    of_row = (F.col("d") == F.col("__d")) & (F.col("t") == F.col("__t"))
    every = stored(anchor_table(docs), "passage-anchors")
    twice = stored(every.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "passage-keys")
    shared = stored(every.join(_small(twice), "key"), "passage-shared")
    contexts = stored(shared.groupBy("key", "digest").agg(
        F.count("*").alias("n"), F.min(F.struct("d", "t", "start", "size", "left")).alias("at"))
        .withColumn("member", F.monotonically_increasing_id()), "passage-contexts")
    per_key = contexts.groupBy("key").agg(F.count("*").alias("members")).where("members > 1").select("key")
    member = F.struct("member", "key", F.col("at.start").alias("start"), F.col("at.size").alias("size"), F.col("at.left").alias("left"))
    members = stored(contexts.join(per_key, "key").groupBy(F.col("at.d").alias("__d"), F.col("at.t").alias("__t")).agg(
        F.collect_list(member).alias("members")), "passage-members")  # the rows of a document, by document
    texts = _holding(docs, members).join(_small(members), of_row).dropDuplicates(["d", "t"])

    # Parts of differing contexts that differ again are what is left to compare.
    parts = stored(texts.select("text", "members").mapInArrow(
        _parts, "core long, part binary, member long, a int, size int, left int"), "passage-parts")
    counted = parts.groupBy("core", "part").agg(
        F.count("*").alias("n"), F.min(F.struct("member", "a", "size", "left")).alias("at"))
    cores = counted.groupBy("core").agg(F.count("*").alias("parts"), F.sum("n").alias("rows")).where("rows > 1")
    cores = stored(cores.select("core", "parts"), "passage-cores")
    counted = stored(counted.join(_small(cores), "core"), "passage-counted")
    # One context of each differing part brings its bytes.
    brings = counted.where("parts > 1").select("core", "part", "parts", F.col("at.left").alias("left"), F.col("at.member").alias("member"),
                                               F.col("at.a").alias("a"), F.col("at.size").alias("size"))
    place = contexts.select("member", F.col("at.d").alias("__d"), F.col("at.t").alias("__t"), F.col("at.start").alias("start"))
    wanted = stored(brings.join(place, "member"), "passage-wanted")
    data, at, common = F.col("text").cast("binary"), F.col("start") + F.col("a") + 1, LENGTH - STEP + 1
    edges = F.concat(
        F.substring(data, at, F.col("left")),
        F.substring(data, at + F.col("left") + common, F.col("size") - F.col("left") - common))
    edges_of = _holding(docs, wanted).join(_small(wanted), of_row).select("core", "part", "parts", "left", edges.alias("edges"))
    edges_of = stored(edges_of.dropDuplicates(["core", "part"]), "passage-edges")

    small = edges_of.where(F.col("parts") <= group)
    collections = max(1, -(-small.count() // collection))
    found = small.groupBy(F.pmod(F.xxhash64("core"), F.lit(collections)).alias("__c")).applyInPandas(_collection, _FOUND)
    strings = edges_of.where(F.col("parts") > group).mapInArrow(
        _strings, "core long, part binary, at int, start int, string binary")
    often = strings.groupBy("core", "at", "string").agg(F.count("*").alias("n")).where("n > 1")
    large = strings.join(often.select("core", "at", "string"), ["core", "at", "string"]).select(
        "core", "part", F.struct(F.col("start").alias("a"), (F.col("start") + LENGTH).alias("b")).alias("r"))
    large = large.groupBy("core", "part").agg(merged(F.collect_set("r")).alias("r")).select("core", "part", F.inline("r"))
    whole = counted.where("n > 1").select("core", "part", F.lit(0).alias("a"), F.col("at.size").alias("b"))
    of_part = stored(found.unionByName(large).unionByName(whole), "passage-found")
    of_member = parts.join(_small(cores.select("core")), "core").join(
        of_part.select("core", "part", F.col("a").alias("from"), F.col("b").alias("to")), ["core", "part"])
    of_member = of_member.select("member", (F.col("a") + F.col("from")).alias("a"), (F.col("a") + F.col("to")).alias("b"))
    of_whole = contexts.where("n > 1").where(F.col("at.size") >= LENGTH).select("member", F.lit(0).alias("a"), F.col("at.size").alias("b"))
    of_context = of_member.unionByName(of_whole).groupBy("member").agg(merged(F.collect_set(F.struct("a", "b"))).alias("ranges"))
    of_context = stored(contexts.select("member", "key", "digest").join(of_context, "member").select("key", "digest", "ranges"), "passage-ranges")
    ranges = shared.join(_small(of_context), ["key", "digest"]).select("d", "t", "start", F.explode("ranges").alias("r"))
    ranges = ranges.select("d", "t", (F.col("start") + F.col("r.a")).alias("a"), (F.col("start") + F.col("r.b")).alias("b"))
    return ranges.groupBy("d", "t").agg(merged(F.collect_set(F.struct("a", "b"))).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) of each row of (doc_id, text); ``kept`` is bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(
        F.col("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("d"), F.xxhash64(text).alias("t"),
        text.alias("text"))
    spans = stored(repeated_spans(keyed.select("d", "t", "text")), "passage-spans").select(
        F.col("d").alias("__d"), F.col("t").alias("__t"), "spans")
    held = _held(keyed, spans)
    joined = held.where("__may").join(_small(spans), (F.col("d") == F.col("__d")) & (F.col("t") == F.col("__t")), "left").select(
        "doc_id", "text", "spans")
    whole = held.where("NOT __may").select("doc_id", "text", F.lit(None).cast(joined.schema["spans"].dataType).alias("spans"))
    joined = joined.unionByName(whole)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[int, int, int, bytes]] = []
            for i in range(b.num_rows):
                data, kept, at, runs = b["text"][i].as_py().encode("utf-8"), [], 0, 0
                for s in b["spans"][i].as_py() or ():  # by start; they may overlap or touch
                    if s["a"] > at or not runs:
                        runs += 1
                        kept.append(data[at: s["a"]])
                    at = max(at, s["b"])
                kept.append(data[at:])
                rest = b"".join(kept)
                rows.append((len(data), len(data) - len(rest), runs, rest))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def op6_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` without their repeated passages."""
    done = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
