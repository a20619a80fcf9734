"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are scaled to length 1, so the nearest by cosine are the nearest by
distance.  A Gaussian (2-stable) matrix projects them to ``DIMS``
dimensions: a projected distance over the true one squared is chi-square
with ``DIMS`` degrees of freedom.  Each shard of vectors is indexed by a
kd-tree of the projections.  For a query, the tree's leaves come in order of
their projected distance, their vectors are verified on the original
components, and the search stops when the chi-square test holds: the next
leaf is so far in projection that a vector nearer than the current k-th
would lie beyond it with a chance of ``1 - CONFIDENCE`` at most.

Vectors are dealt to shards by a hash of their id, queries to blocks; each
block meets each shard in one task, which gives the block's ``k`` best in
that shard, and a query's ``k`` best of all shards are kept.  Blocks and
shards are bounded in rows, so memory is too.

Nearness is the cosine in double precision on the original components, ties
to the smaller ``vec_id``.  Defined results: vectors that are null, empty,
zero or hold null or non-finite components take no part, nor do rows with a
null id; a query meets vectors of its own dimension only; the query's own
row (its id) is no candidate; rows with the same id are one row each and all
take part; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import read_table, stored

DIMS = 8
LEAF = 48
CONFIDENCE = 0.97
K = 5
QUERY_EVERY = 50
SHARD_ROWS = 20_000
BLOCK_ROWS = 4_000
SEED = 11


def chi_square(x: float, dims: int) -> float:
    """Distribution function of the chi-square law with an even number of degrees."""
    half, term, total = x / 2, 1.0, 0.0
    if half > 700:
        return 1.0
    for i in range(dims // 2):
        total += term
        term *= half / (i + 1)
    return 1.0 - math.exp(-half) * total


def far_enough(confidence: float, dims: int) -> float:
    """The x with ``chi_square(x) = confidence``."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < confidence else (low, mid)
    return high


def projection(dim: int, dims: int = DIMS) -> np.ndarray:
    """The Gaussian matrix; the same in every task."""
    return np.random.default_rng(SEED + dim).standard_normal((dim, dims))


class KdTree:
    """Leaves of at most ``LEAF`` projected points with their bounding boxes."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        order = np.arange(len(points))
        self.leaves: list[np.ndarray] = []
        todo = [order]
        while todo:
            part = todo.pop()
            own = points[part]
            spread = own.max(axis=0) - own.min(axis=0)
            axis = int(spread.argmax())
            if len(part) <= leaf or spread[axis] == 0:
                self.leaves.append(part)
                continue
            half = len(part) // 2
            by = np.argpartition(own[:, axis], half)
            todo += [part[by[:half]], part[by[half:]]]
        self.low = np.array([points[x].min(axis=0) for x in self.leaves])
        self.high = np.array([points[x].max(axis=0) for x in self.leaves])

    def leaf_distances(self, q: np.ndarray) -> np.ndarray:
        """Squared distances from ``q`` to the leaves' boxes."""
        gap = np.maximum(np.maximum(self.low - q, q - self.high), 0.0)
        return (gap * gap).sum(axis=1)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component to
    [0.5, 1): exact, and no square under- or overflows.  Cosines stay as they are."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1))[1][:, None])


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int = K,
           confidence: float = CONFIDENCE) -> list[tuple[int, int, float]]:
    """(query id, vector id, cosine) of each query's ``k`` best found."""
    vectors, queries = scaled(vectors), scaled(queries)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    units = vectors / norms[:, None]
    matrix = projection(vectors.shape[1])
    tree = KdTree(units @ matrix)
    enough = far_enough(confidence, DIMS)
    out: list[tuple[int, int, float]] = []
    for q, own_id in zip(queries, query_ids, strict=True):
        q_norm = math.sqrt((q * q).sum())
        gaps = tree.leaf_distances(q / q_norm @ matrix)
        order = np.argsort(gaps, kind="stable")
        best: list[tuple[float, int]] = []  # heap of (cosine, -id): the worst first
        for leaf in order:
            if len(best) == k:
                worst = max(2.0 - 2.0 * best[0][0], 0.0)  # squared distance of unit vectors
                if gaps[leaf] > enough * worst + 1e-9:
                    break
            rows = tree.leaves[leaf]
            cosine = (vectors[rows] * q).sum(axis=1) / (norms[rows] * q_norm)
            if len(best) == k:
                near = cosine >= best[0][0]
                rows, cosine = rows[near], cosine[near]
            for c, v in zip(cosine.tolist(), ids[rows].tolist(), strict=True):
                if v == own_id:
                    continue
                if len(best) < k:
                    heapq.heappush(best, (c, -v))
                elif (c, -v) > best[0]:
                    heapq.heapreplace(best, (c, -v))
        out += [(int(own_id), -v, c) for c, v in best]
    return out


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS,
            confidence: float = CONFIDENCE) -> DataFrame:
    """(query_id, rank, vec_id, score) for (vec_id, v) tables of vectors and queries."""
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))  # a repeated query id: its smallest vector
    n_vectors, n_queries = vectors.count(), queries.count()
    shards, blocks = max(1, -(-n_vectors // shard_rows)), max(1, -(-n_queries // block_rows))
    of = F.pmod(F.xxhash64("vec_id"), F.lit(shards))
    right = vectors.select(of.alias("shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "v")
    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int")
    left = queries.select(
        F.explode(F.sequence(*(F.lit(x).cast("long") for x in (0, shards - 1)))).alias("shard"),
        block.alias("block"), "vec_id", "v")

    def meet(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, float]] = []
        own_dims, row_dims = own["v"].map(len), rows["v"].map(len)
        for dim in own_dims.unique():
            q, x = own[own_dims == dim], rows[row_dims == dim]
            if len(x):
                found += search(np.stack(x["v"].to_list()), x["vec_id"].to_numpy(), np.stack(q["v"].to_list()),
                                q["vec_id"].to_numpy(), k, confidence)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbours of every ``QUERY_EVERY``-th row of ``embeddings``."""
    vectors = stored(usable(read_table(spark, sf_dir, "embeddings")), "search-vectors")
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
