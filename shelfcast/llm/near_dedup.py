"""Near-duplicate documents by order MinHash and banded alignment.

Shingles are five words.  Every shingle is labelled with its occurrence
number in the document; one sketch takes the ``MINIMA`` labelled shingles of
least hash and hashes them in text order, so two documents agree in a sketch
when those shingles are shared and stand in the same order.  ``SKETCHES``
sketches give each document as many buckets.  Links are defined on sets of
shingles, so ``SET_SKETCHES`` more take the ``MINIMA`` different shingles of
least hash without order and occurrence: at a similarity of 0.8 a pair misses
all of those with a chance of about 2e-4, whether blocks are moved or repeated
or not (texts with the same set never).  Texts of ``SHORT`` different shingles
or less have ``SHORT_SKETCHES`` more, as three of few shingles are shared less
often: 4 of 5 shared miss all 18 with a chance of 1e-4.

Documents equal word for word are one node.  In each bucket the node of
greatest support (the sizes of all its buckets), its pivot, is compared with
every other one.

Rows that met the same pivot are a group.  Groups that still hold two classes
are dealt into blocks of bounded size, and every two blocks of a group are
compared by one matrix product, which counts the shared shingles of all their
rows.  Of the pairs of other classes that share enough, those that join
classes not yet joined are verified as well, so of a large group at most one
pair a row and block is kept.  Documents that agree in a sketch end in one
class or share too little; a link is missed only if the two agree in no sketch.

A pair is verified on whole texts: the words are aligned within a band of
diagonals, and runs of aligned words give the shared shingles in order; 0.8
or more of all link the pair.  Pairs whose sets of shingles share less, which
bounds every alignment, aren't aligned.  Where the alignment leaves the band or says
less (moved blocks), or shingles repeat, the sets of shingles decide: linked
pairs are exactly those of Jaccard similarity 0.8 or more.  Classes are the
connected components; a class is named by its smallest ``doc_id``.

Defined results: a text without words (null, empty) is a class of its own;
a text of one to four words is one shingle; a null ``doc_id`` orders last and
stays null in its class's name if it is alone; rows with the same id are
nodes by their texts; one row stands for a class, also among rows equal in id
and text (the least by a hash of the other columns, then by the number the
row got as the table was stored); other columns are kept by ``classes``; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import small_side
from .common import LAST_ID, giving_back, read_table, stored
from .components import components
from .lexis import slices

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 12
SET_SKETCHES = 12
SHORT = 20
SHORT_SKETCHES = 6
MINIMA = 3
MAX_BAND = 64
BLOCK_ROWS = 1000
BLOCK_SHINGLES = 1_000_000  # of a block, about
PRODUCT_CELLS = 4_000_000  # of a matrix of rows by shingles
SLICE_BYTES = 1_000_000  # of text, sketched at a time

_MAX = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words in a row, words of each text)."""
    lists = pc.ascii_split_whitespace(pa.array(texts, pa.string()))
    count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    codes = coded.indices.to_numpy().astype(np.int64)
    if "" in words:  # around leading and trailing white space
        real = codes != words.index("")
        text = np.repeat(np.arange(len(texts)), count)
        count = np.bincount(text[real], minlength=len(texts))
        codes = codes[real]
    return hashes[codes], count


def shingles(hashes: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles in a row, shingles of each text)."""
    n = np.where(count == 0, 0, np.maximum(count - WORDS + 1, 1))
    padded = np.concatenate([hashes, np.zeros(WORDS, np.uint64)])
    starts = np.cumsum(count) - count
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    short = np.repeat(count, n)
    out = np.zeros(len(at), np.uint64)
    for k in range(WORDS):
        word = padded[at + k]
        word[short <= k] = 0
        out = _mix(out + word) if k else _mix(word + np.uint64(1))
    return out, n


def sketches(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(texts with shingles, SKETCHES) order MinHash keys."""
    n = n[n > 0]
    texts = len(n)
    if not texts:
        return np.zeros((0, SKETCHES), np.int64)
    begin = np.cumsum(n) - n
    text = np.repeat(np.arange(texts), n)
    # Occurrence number of each shingle in its text.
    order = np.lexsort((hashes, text))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    at = np.arange(len(order))
    occurrence = np.empty(len(order), np.uint64)
    occurrence[order] = (at - np.maximum.accumulate(np.where(first, at, 0))).astype(np.uint64)
    label = hashes + occurrence * np.uint64(0xD6E8FEB86659FD93)
    out = np.zeros((texts, SKETCHES), np.uint64)
    for s in range(SKETCHES):
        value = _mix(label ^ np.uint64(0x5851F42D4C957F2D * (s + 1) % 2**64))
        places = np.full((MINIMA, texts), len(hashes))
        for m in range(MINIMA):
            least = np.minimum.reduceat(value, begin)
            found = np.flatnonzero((value == np.repeat(least, n)) & (value != _MAX))
            places[m, text[found]] = found
            value[found] = _MAX
        places.sort(axis=0)  # text order
        key = np.full(texts, s + 1, np.uint64)
        picked = np.concatenate([hashes, np.zeros(1, np.uint64)])
        for m in range(MINIMA):
            key = _mix(key * np.uint64(31) + picked[places[m]])
        out[:, s] = key
    return out.view(np.int64)


def set_sketches(hashes: np.ndarray, n: np.ndarray) -> list[list[int]]:
    """MinHash keys of each text with shingles, over its different shingles in any order."""
    n = n[n > 0]
    text = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((hashes, text))
    hashes, text = hashes[order], text[order]
    first = np.ones(len(order), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])
    different = np.bincount(text[first], minlength=len(n))

    def keys(pool: np.ndarray, size: np.ndarray, seeds: range) -> np.ndarray:
        out = np.zeros((len(size), len(seeds)), np.uint64)
        begin = np.cumsum(size) - size
        for s, seed in enumerate(seeds if len(size) else ()):
            value = _mix(pool ^ np.uint64(0x5851F42D4C957F2D * (seed + 1) % 2**64))
            key = np.full(len(size), seed + 1, np.uint64)
            for _ in range(MINIMA):
                least = np.minimum.reduceat(value, begin)
                value[value == np.repeat(least, size)] = _MAX
                key = _mix(key * np.uint64(31) + least)
            out[:, s] = key
        return out.view(np.int64)

    last = SKETCHES + SET_SKETCHES
    out = keys(hashes[first], different, range(SKETCHES, last)).tolist()
    short = different <= SHORT
    more = keys(hashes[first & short[text]], different[short], range(last, last + SHORT_SKETCHES)).tolist()
    for i, own in zip(np.flatnonzero(short), more, strict=True):
        out[i] += own
    return out


def _row_key() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("d"), F.xxhash64(text).alias("t")]


def numbered(docs: DataFrame) -> DataFrame:
    """(row, d, t, o, text, __doc) of each row, stored: ``row`` is its number, ``o`` a hash of the columns
    besides id and text, ``__doc`` all of ``docs``."""
    other = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    o = F.xxhash64(F.to_json(F.struct(*other))) if other else F.lit(0).cast("long")
    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    return stored(docs.select(F.monotonically_increasing_id().alias("row"), *_row_key(), o.alias("o"), "text", doc.alias("__doc")), "near-rows")


def sketch_table(docs: DataFrame) -> DataFrame:
    """(row, d, t, o, node, n, keys) of each of the ``numbered`` rows; ``node`` is a digest of its
    words, null without words, ``n`` the number of its different shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, limit=SLICE_BYTES):
            hashes, count = word_hashes(b["text"].to_pylist())
            found, total = shingles(hashes, count)
            keys = (a + b for a, b in zip(sketches(found, total).tolist(), set_sketches(found, total), strict=True))
            stop = np.cumsum(count)
            node = [
                hashlib.blake2b(hashes[e - n: e].tobytes(), digest_size=16).digest() if n else None
                for e, n in zip(stop, count, strict=True)
            ]
            yield pa.RecordBatch.from_arrays([
                *(b[c] for c in ("row", "d", "t", "o")), pa.array(node, pa.binary()),
                pa.array([len(np.unique(found[e - m: e])) for e, m in zip(np.cumsum(total), total, strict=True)], pa.int64()),
                pa.array([next(keys) if n else None for n in count], pa.list_(pa.int64())),
            ], names=["row", "d", "t", "o", "node", "n", "keys"])

    return docs.select("row", "d", "t", "o", "text").mapInArrow(
        giving_back(sketch), "row long, d long, t long, o long, node binary, n long, keys array<long>")


# -- verification ---------------------------------------------------------


def _slide(a: np.ndarray, b: np.ndarray, i: int, j: int) -> int:
    """How many words from ``i`` and ``j`` on are equal."""
    run, step = 0, 32
    while True:
        m = min(step, len(a) - i, len(b) - j)
        if m <= 0:
            return run
        same = a[i: i + m] == b[j: j + m]
        if not same.all():
            return run + int(same.argmin())
        i, j, run, step = i + m, j + m, run + m, step * 4


def aligned_shingles(a: np.ndarray, b: np.ndarray, band: int) -> int | None:
    """Shingles shared in order by an alignment of least edits; None if it leaves the band.

    Furthest-reaching words by number of edits and diagonal (b's place less
    a's), diagonals ``-band`` to ``band`` and at most ``band`` edits.
    """
    goal = len(b) - len(a)
    if abs(goal) > band:
        return None
    reach: list[dict[int, int]] = []  # by edits: diagonal -> words of a aligned
    for edits in range(band + 1):
        row: dict[int, int] = {}
        last = reach[-1] if reach else {}
        for k in range(-edits, edits + 1):
            if edits == 0:
                i = 0
            else:
                i = max(last.get(k, -2) + 1, last.get(k - 1, -2), last.get(k + 1, -2) + 1)
            if i < 0:
                continue
            i = min(i, len(a), len(b) - k)
            if i < 0 or i + k < 0:
                continue
            row[k] = i + _slide(a, b, i, i + k)
        reach.append(row)
        if row.get(goal, -1) >= len(a):
            break
    else:
        return None
    # Walk back: a run of r aligned words holds r - 4 shingles.
    shared, k, end = 0, goal, len(a)
    for edits in range(len(reach) - 1, -1, -1):
        if edits == 0:
            start, before = 0, k
        else:
            last = reach[edits - 1]
            moves = ((last.get(k, -2) + 1, k), (last.get(k - 1, -2), k - 1), (last.get(k + 1, -2) + 1, k + 1))
            start, before = max(moves, key=lambda m: m[0])
            start = min(start, len(a), len(b) - k)
        shared += max(0, end - start - WORDS + 1)
        if edits:
            end = reach[edits - 1][before]
        k = before
    return shared


def _parts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes, different shingles in order) of a text."""
    hashes, count = word_hashes([text])
    return hashes, np.unique(shingles(hashes, count)[0])


def distance(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> float:
    """Shingle-set distance of two texts, given as word hashes and different shingles; of a link an upper
    bound of at most ``1 - least``.

    An alignment shares no more shingles than the sets do, so what the sets
    exclude isn't aligned.
    """
    most = len(np.intersect1d(x, y, assume_unique=True))
    both = len(x) + len(y) - most
    if most < least * both:
        return max(1 - most / both, float(np.nextafter(1 - least, 1)))
    sa, sb = max(len(a) - WORDS + 1, 1), max(len(b) - WORDS + 1, 1)
    if len(x) == sa and len(y) == sb and min(len(a), len(b)) >= WORDS:  # no shingle repeats: an alignment is proof
        # As many words may differ as replace (1 - least) / (1 + least) of all shingles one by one.
        band = min(MAX_BAND, WORDS + int((sa + sb) * (1 - least) / (1 + least) / 2))
        shared = aligned_shingles(a, b, band)
        if shared is not None and shared >= least * (sa + sb - shared):
            return min(1 - shared / (sa + sb - shared), 1 - least)
    return min(1 - most / both, 1 - least)  # moved blocks, repeated shingles, wide edits


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether two texts, as word hashes, are near duplicates."""
    x, y = (np.unique(shingles(w, np.array([len(w)]))[0]) for w in (a, b))
    return distance(a, x, b, y, least) <= 1 - least


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, dist, ok) of the pairs, compared on whole texts."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right = None, None
        for batch in batches:
            dist = []
            for i in range(batch.num_rows):
                if (key := batch["b"][i].as_py()) != last:  # the join often leaves equal b side by side
                    last, right = key, _parts(batch["tb"][i].as_py())
                dist.append(float(distance(*_parts(batch["ta"][i].as_py()), *right)))
            ok = [d <= 1 - SIMILARITY for d in dist]
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(dist, pa.float64()), pa.array(ok, pa.bool_())], names=["a", "b", "dist", "ok"])

    ta = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").select("a", "b", "ta", "tb").mapInArrow(
        giving_back(compare), "a binary, b binary, dist double, ok boolean")


def shared_shingles(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of the ``left`` sets shares with each of the ``right`` ones."""
    sets = left + right
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = df[code] > 1  # the others are shared with nobody
    row, code = row[kept], np.unique(code[kept], return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    row, code = row[order], code[order]
    out = np.zeros((len(left), len(right)), np.float32)  # whole numbers below 2 ** 24
    width = max(1, PRODUCT_CELLS // len(sets))
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        part = slice(*np.searchsorted(code, [first, first + width]))
        cells = np.zeros((len(sets), width), np.float32)
        cells[row[part], code[part] - first] = 1
        out += cells[: len(left)] @ cells[len(left):].T
    return out.astype(np.int64)


def joining_pairs(sets: list[np.ndarray], label: list[bytes], left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Linked pairs of a ``left`` and a ``right`` row that join the classes of all such pairs."""
    size = np.array([len(x) for x in sets])
    most = shared_shingles([sets[i] for i in left], [sets[i] for i in right])
    both = size[left][:, None] + size[right][None, :] - most
    name = np.unique(np.array([x.hex() for x in label]), return_inverse=True)[1]
    linked = (most >= SIMILARITY * both) & (name[left][:, None] != name[right][None, :])
    root, out = list(range(len(sets))), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(*(at.tolist() for at in np.nonzero(linked)), strict=True):
        x, y = top(name[left[i]]), top(name[right[j]])
        if x != y:
            root[x] = y
            out.append((int(left[i]), int(right[j])))
    return out


def block_pairs(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): the pairs within the groups of (pivot, node, n, label) rows that join classes, from all pairs compared
    block by block."""
    group = rows.groupBy("pivot").agg(F.min("label").alias("l0"), F.max("label").alias("l1"), F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK_ROWS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).alias("blocks"))
    rows = rows.join(group.where("l0 <> l1").select("pivot", "blocks"), "pivot")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), "blocks")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select("pivot", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "label")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done() -> pa.RecordBatch:
            block = np.array([r["block"] for r in held])
            left, right = (np.flatnonzero(block == key[k]) for k in (1, 2))
            found = joining_pairs([_parts(r["text"])[1] for r in held], [r["label"] for r in held], left, right)
            pairs = [sorted((held[x]["node"], held[y]["node"])) for x, y in found]
            return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.binary()) for k in (0, 1)], names=["a", "b"])

        key, held = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if (own := (r["pivot"], r["i"], r["j"])) != key:
                    if held:
                        yield done()
                    key, held = own, []
                held.append(r)
        if held:
            yield done()

    text = texts.select(F.col("node").alias("__node"), "text")
    return rows.join(text, F.col("node") == F.col("__node")).drop("__node").repartition("pivot", "i", "j").sortWithinPartitions(
        "pivot", "i", "j").mapInArrow(giving_back(compare), "a binary, b binary").distinct()


def links(nodes: DataFrame, texts_of: DataFrame) -> DataFrame:
    """Verified (a, b) links of (node, best, n, keys) nodes whose components are
    the classes; ``texts_of`` has (row, text)."""
    each = nodes.select("node", "n", F.posexplode("keys").alias("band", "key"))
    # Support: the sizes of all buckets of a node.
    sizes = each.groupBy("band", "key").agg(F.count("*").alias("size")).where("size > 1")
    shared = stored(each.join(sizes, ["band", "key"]), "near-buckets")
    support = shared.groupBy("node").agg(F.sum("size").alias("support"))
    rows = shared.join(support, "node").select(F.struct("band", "key").alias("bucket"), "node", "n", "support")
    pivot = rows.groupBy("bucket").agg(F.max(F.struct("support", "node")).alias("best"))
    rows = stored(rows.join(pivot.select("bucket", F.col("best.node").alias("pivot")), "bucket").drop("support"), "near-rows")

    wanted = stored(nodes.join(support.select("node"), "node", "left_semi").select(F.col("best.row").alias("__row"), "node"), "near-wanted")
    texts = texts_of.join(small_side(wanted), F.col("row") == F.col("__row"))
    texts = stored(texts.select("node", "text"), "near-texts")

    # Every row against its bucket's pivot; the pivot is done then.
    rows = rows.where("node <> pivot").select("pivot", "node", "n").distinct()
    pairs = rows.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()
    met = stored(verified(pairs, texts), "near-verified").where("ok").select("a", "b")
    labelled = rows.join(small_side(components(met)), "node", "left").withColumn("label", F.coalesce("label", "node"))
    joins = stored(block_pairs(stored(labelled, "near-labelled"), texts), "near-joins")
    return met.unionByName(stored(verified(joins, texts), "near-joined").where("ok").select("a", "b"))


def classes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__class``, the smallest id of the row's class, and
    ``__kept``, whether the row is the one that stands for its class."""
    rows = numbered(docs)
    table = stored(sketch_table(rows), "near-sketches").where("node is not null")
    nodes = stored(table.groupBy("node").agg(
        F.min(F.struct("d", "t", "o", "row")).alias("best"), F.first("n").alias("n"), F.first("keys").alias("keys")), "near-nodes")
    linked = links(nodes, rows.select("row", F.coalesce(F.col("text"), F.lit("")).alias("text")))
    labels = components(linked)
    named = nodes.join(labels, "node", "left").select("node", "best", F.coalesce("label", "node").alias("label"))
    best = named.groupBy("label").agg(F.min("best").alias("best"))
    named = stored(named.drop("best").join(best, "label").select("node", "best.d", "best.row"), "near-classes")
    named = named.select("node", F.col("d").alias("__d"), F.col("row").alias("__best"))
    of = stored(table.select(F.col("row").alias("__row"), "node").join(named, "node").drop("node"), "near-of")
    joined = rows.join(small_side(of), F.col("row") == F.col("__row"), "left")
    name = F.coalesce("__d", "d")
    return joined.select(
        *[F.col("text") if c == "text" else F.col(f"__doc.`{c}`").alias(c) for c in docs.columns],
        F.when(name != LAST_ID, name).alias("__class"),
        (F.col("__best").isNull() | (F.col("__best") == F.col("row"))).alias("__kept"),
    )


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The classes of all ``documents``."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs).select("doc_id", F.col("__class").alias("class_id"), F.col("__kept").alias("kept"))
