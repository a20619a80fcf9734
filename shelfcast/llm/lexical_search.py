"""Ranked lexical search: every item against every document by dense blocked
matrix products.

Three steps, the first and the last in NumPy on Arrow batches.  (1) The
documents' words are looked up in the items' vocabulary; a document keeps its
number of words and the (term, occurrences) it shares with any item, stored
in the shared folder.  (2) Spark counts documents, words and, by term, the
documents that hold it.  (3) Items come in tiles of ``TILE_ITEMS`` with the
compact vocabulary of just these items.  Per slab of documents the terms'
impacts fill a dense matrix, and the item matrix of ones and zeros times it
gives the scores.  Products run in float64 over column tiles so narrow that
every partial sum stays below 2^53; all summands are whole numbers, so any
order of the sums (and fused multiply-adds) is exact.  Tiles add up in 64-bit
integers.

Top k: a slab's scores that reach an item's k-th best so far stay, equal
scores included, then score and id decide; each task leaves at most k rows an
item.  The tasks' rows are ranked in ``SPREAD`` groups an item first, then as
a whole.

Items are a query set against all rows.  Rounds of about ``ROUND_TERMS`` item
terms and ``ROUND_ITEMS`` items (by a hash of a row number; a single item may
have more) go to the tasks with the plan, so what is sent is bounded however
many items there are; each round reads the documents once.

Defined results: an ``item_id`` (null is one) with several rows counts once,
with its smallest text that isn't null; rows of documents with equal ids are
ranked each, a null ``doc_id`` after all others of its score; null and empty
texts have no terms and are in neither N nor L; items without a scoring
document have no rows; other columns are ignored; empty tables give an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LAST_ID, read_table, stored
from .lexis import slices, split_words

TOP = 50
TILE_ITEMS = 256
TILE_TERMS = 4096
SLAB_DOCS = 512
ROUND_TERMS = 500_000
ROUND_ITEMS = 8_192
SPREAD = 64
MOST_IMPACT = 10**6  # an impact is below its term's weight times this
EXACT = 2**53

POSTINGS = "doc_id long, n long, terms array<int>, times array<long>"


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item."""
    for part in slices(batches):
        words = split_words(part.column("text"))
        lists = pa.LargeListArray.from_arrays(pa.array(words.first), words.array().cast(pa.large_string()))
        terms = [list(dict.fromkeys(t)) for t in lists.to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("item_id"), pa.array(terms, pa.list_(pa.string()))], ["item_id", "terms"])


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and the distinct terms of its text, one row an id."""
    one = items.groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.min("text").alias("text"))
    terms = one.mapInArrow(_vocabulary, "item_id long, terms array<string>").where(F.size("terms") > 0)
    return stored(terms.withColumn("__row", F.monotonically_increasing_id()), "search-items")


def postings(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id``, number of words, and number and occurrences of the vocabulary's terms, for documents with words."""
    known = pa.array([t.encode() for t in vocabulary], pa.large_binary())

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            words = split_words(part.column("text"))
            n = words.per_text
            place = pc.index_in(words.array(), value_set=known)
            held = pc.is_valid(place).to_numpy(zero_copy_only=False)
            term = pc.drop_null(place).to_numpy().astype(np.int64)
            of = np.repeat(np.arange(part.num_rows), n)[held]
            both, times = np.unique(of * max(1, len(known)) + term, return_counts=True)
            of, term = np.divmod(both, max(1, len(known)))
            some = np.flatnonzero(n)
            cuts = pa.array(np.append(np.searchsorted(of, some), len(of)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(some)), pa.array(n[some].astype(np.int64)),
                 pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                 pa.ListArray.from_arrays(cuts, pa.array(times.astype(np.int64)))],
                ["doc_id", "n", "terms", "times"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(look_up, POSTINGS)


def term_weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


@dataclass
class Tile:
    """Items with the compact vocabulary of their terms: ``terms`` in order
    and their ``weight``; ``row`` and ``column`` are where the matrix of
    items by terms holds a 1 (by column)."""

    first: int
    size: int
    terms: np.ndarray
    weight: np.ndarray
    row: np.ndarray
    column: np.ndarray


def item_tiles(items: list[np.ndarray], weight: np.ndarray) -> Iterator[Tile]:
    for a in range(0, len(items), TILE_ITEMS):
        own = items[a: a + TILE_ITEMS]
        row, term = np.repeat(np.arange(len(own)), [len(t) for t in own]), np.concatenate(own)
        row, term = row[weight[term] > 0], term[weight[term] > 0]
        order = np.argsort(term, kind="stable")
        terms, column = np.unique(term[order], return_inverse=True)
        yield Tile(a, len(own), terms, weight[terms], row[order], column)


def tile_scores(tile: Tile, doc: np.ndarray, term: np.ndarray, share: np.ndarray, n_docs: int) -> np.ndarray:
    """Scores of a tile's items (rows) and a slab's documents (columns)."""
    scores = np.zeros((tile.size, n_docs), np.int64)
    if not len(tile.terms):
        return scores
    column = np.minimum(np.searchsorted(tile.terms, term), len(tile.terms) - 1)
    own = np.flatnonzero(tile.terms[column] == term)
    column, doc, share = column[own], doc[own], share[own]
    width = max(1, min(TILE_TERMS, (EXACT - 1) // (int(tile.weight.max()) * MOST_IMPACT)))
    for a in range(0, len(tile.terms), width):
        b = min(a + width, len(tile.terms))
        of = np.flatnonzero((column >= a) & (column < b))
        impact = np.zeros((b - a, n_docs))
        impact[column[of] - a, doc[of]] = tile.weight[column[of]] * share[of]
        cells = slice(*np.searchsorted(tile.column, (a, b)))
        holds = np.zeros((tile.size, b - a))
        holds[tile.row[cells], tile.column[cells] - a] = 1.0
        scores += (holds @ impact).astype(np.int64)
    return scores


class Best:
    """The highest (score, then smallest id) of each item so far."""

    def __init__(self, items: int, top: int) -> None:
        self.top, self.items = top, items
        self.bar = np.ones(items, np.int64)  # what a score must reach
        self.rows = [np.zeros(0, np.int64)] * 3  # item, score, id
        self.waiting: list[list[np.ndarray]] = []

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.bar[first: first + len(scores), None])
        self.waiting.append([item + first, scores[item, doc], ids[doc]])
        if sum(len(w[0]) for w in self.waiting) > 4 * self.items * self.top:
            self.settle()

    def settle(self) -> None:
        item, score, ids = (np.concatenate([r, *(w[i] for w in self.waiting)]) for i, r in enumerate(self.rows))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        keep = rank < self.top
        last = rank == self.top - 1
        self.bar[item[last]] = score[last]
        self.rows, self.waiting = [item[keep], score[keep], ids[keep]], []


def _rank(stored_postings: DataFrame, ids: list[int | None], items: list[np.ndarray], weight: np.ndarray,
          n_docs: int, n_words: int, top: int) -> DataFrame:
    """Each task's best documents of each item."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(items), top)
        tiles = list(item_tiles(items, weight))
        for batch in batches:
            for a in range(0, batch.num_rows, SLAB_DOCS):
                part = batch.slice(a, SLAB_DOCS)
                per_doc = pc.list_value_length(part.column("terms")).to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(part.num_rows), per_doc)
                term = part.column("terms").flatten().to_numpy()
                times = part.column("times").flatten().to_numpy()
                # Whole-number division in Python: 50 * n * N may exceed 64 bits.
                length = np.array([50 + 50 * n * n_docs // n_words for n in part.column("n").to_pylist()], np.int64)
                share = (1_000_000_000 * times) // (1000 * times + 20 * length[doc])
                doc_ids = pc.fill_null(part.column("doc_id"), LAST_ID).to_numpy()
                for tile in tiles:
                    best.add(tile.first, tile_scores(tile, doc, term, share, part.num_rows), doc_ids)
        best.settle()
        item, score, doc_id = best.rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()).take(pa.array(item)), pa.array(item.astype(np.int32)), pa.array(score), pa.array(doc_id)],
            ["item_id", "item", "score", "doc_id"])

    return stored_postings.where(F.size("terms") > 0).mapInArrow(search, "item_id long, item int, score long, doc_id long")


def _round(docs: DataFrame, chosen: list, top: int) -> DataFrame:
    """Ranked documents of one round's items."""
    vocabulary = list(dict.fromkeys(t for r in chosen for t in r.terms))
    number = {t: i for i, t in enumerate(vocabulary)}
    items = [np.array([number[t] for t in r.terms]) for r in chosen]
    held = stored(postings(docs, vocabulary), "search-postings")
    n_docs, n_words = held.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    for row in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[row[0]] = row[1]  # at most a row for each term of the round
    found = _rank(held, [r.item_id for r in chosen], items, term_weights(n_docs, df), n_docs, n_words, top)
    order = [F.col("score").desc(), F.col("doc_id")]
    group = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SPREAD))
    first = Window.partitionBy("item", group).orderBy(*order)
    near = found.withColumn("__at", F.row_number().over(first)).where(F.col("__at") <= top).drop("__at")
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
    return ranked.where(F.col("rank") <= top).select(
        "item_id", "rank", F.when(F.col("doc_id") != LAST_ID, F.col("doc_id")).alias("doc_id"), "score")


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """``item_id``, rank, ``doc_id`` and score of each item's best documents."""
    terms = item_terms(items)
    n_items, n_terms = terms.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
    rounds = max(1, -(-n_items // ROUND_ITEMS), -(-n_terms // ROUND_TERMS))
    out = None
    for number in range(rounds):
        chosen = terms.where(F.pmod(F.xxhash64("__row"), F.lit(rounds)) == number).collect()
        part = stored(_round(docs, chosen, top), "search-ranked")
        out = part if out is None else out.unionByName(part)
    return out


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of each benchmark item."""
    return search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
