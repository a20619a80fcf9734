"""Per-group building blocks that stay safe when one group is huge.

A window partitioned by a group key sends a whole group to one task.  The
helpers here avoid that:

* group statistics are grouped aggregations (partial aggregation before the
  shuffle) joined back to the rows, the statistics side broadcast only
  under a size check;
* "previous row in the group" splits each group into calendar chunks, runs
  the window inside each chunk and takes each chunk's first row, with the
  previous chunk's last value, from a per-chunk aggregate (no join);
* "latest row per group" narrows each group to its rows at the greatest
  order value (hash aggregate + semi join) before a ``max_by``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import small_side


def attach_group_stats(
    df: DataFrame, keys: list[str], stats: dict[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Add per-group aggregates as columns of every row (left join on keys).

    The aggregates are computed over ``source`` (default ``df``): pass the
    plain input when ``df`` is derived from it by costlier steps.
    """
    agg = (df if source is None else source).groupBy(*keys).agg(*[v.alias(k) for k, v in stats.items()])
    renamed = agg.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *stats)
    cond = None
    for k in keys:
        term = df[k].eqNullSafe(renamed[f"__g_{k}"])
        cond = term if cond is None else cond & term
    joined = df.join(small_side(renamed), cond, "left")
    return joined.drop(*[f"__g_{k}" for k in keys])


def previous_in_group(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    out: str,
    chunk: Column | None = None,
) -> DataFrame:
    """``lag(value)`` over ``keys`` ordered by ``order`` without one task per group.

    ``chunk`` must be monotone in the order (e.g. the first order column).
    Rows after the first of a (group, chunk) take their lag from a window
    inside that chunk.  The first row of each chunk comes from the
    per-chunk aggregate (one row per group and chunk: the chunk's first
    row, found by ``min_by``, and its last value), whose own lag over the
    group's chunks gives the previous chunk's last value.  A hot group is
    spread over its chunks; the window over chunks holds one row per chunk
    of a group (bounded by the calendar when the chunk is a date).  No join:
    the two parts are unioned.  Rows equal in the whole ordering are
    interchangeable, so the window and ``min_by`` agree on ties.

    ``chunk=None`` chunks by the first order column.  When the rows are
    just (keys, that column, value) ordered by (column, value), a chunk's
    first row is its NULL value if it has one, else its minimum, and its
    last value is the maximum: plain aggregates, hash-aggregated with no
    map-side sort.
    """
    others = [c for c in df.columns if c not in keys]
    full = [*order, *[c for c in others if c not in order]]
    rank = F.struct(*[F.col(c) for c in full])
    framed = df.withColumn("__p_chunk", F.col(order[0]) if chunk is None else chunk)
    wc = Window.partitionBy(*keys).orderBy("__p_chunk")

    w = Window.partitionBy(*keys, "__p_chunk").orderBy(*[F.col(c) for c in full])
    inner = framed.select(*df.columns, F.lag(value).over(w).alias(out), F.row_number().over(w).alias("__p_rn"))
    inner = inner.where(F.col("__p_rn") > 1).drop("__p_rn")

    if chunk is None and order[1:] == [value] and sorted(others) == sorted(order):
        v = F.col(value)
        chunks = framed.groupBy(*keys, "__p_chunk").agg(
            F.when(F.count_if(v.isNull()) > 0, F.lit(None)).otherwise(F.min(v)).alias(value),
            F.max(v).alias("__p_last"),
        )
        firsts = chunks.select(
            *keys, F.col("__p_chunk").alias(order[0]), value, F.lag("__p_last").over(wc).alias(out)
        )
        return inner.unionByName(firsts.select(*df.columns, out))

    chunks = framed.groupBy(*keys, "__p_chunk").agg(
        F.min_by(F.struct(*[F.col(c) for c in others]), rank).alias("__p_first"),
        F.max_by(F.col(value), rank).alias("__p_last"),
    )
    firsts = chunks.select(
        *keys, *[F.col(f"__p_first.{c}").alias(c) for c in others], F.lag("__p_last").over(wc).alias(out)
    )
    return inner.unionByName(firsts.select(*df.columns, out))


def latest_per_group(df: DataFrame, keys: list[str], order: list[str], narrow: bool = True) -> DataFrame:
    """The row with the greatest ``order`` tuple per group (ties: greatest whole row).

    With ``narrow`` (for a ``df`` that is cheap to read twice: a stored
    table or a scan), the greatest first order value per group is a hash
    aggregate (partial before the shuffle); a null-safe semi join on (keys,
    that value) keeps only each group's rows at it, and ``max_by`` of the
    whole row picks among those few rows, so the struct-valued (sort-based)
    aggregate never sees the whole frame.  Without it (``df`` is a costly
    derived frame, e.g. a join), ``max_by`` runs over ``df`` directly,
    partially aggregated, and ``df`` is computed once.
    """
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    rank = F.struct(*[F.col(o) for o in order], row)
    if not narrow:
        picked = df.groupBy(*keys).agg(F.max_by(row, rank).alias("__row"))
        return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])
    first = order[0]
    top = df.groupBy(*keys).agg(F.max(first).alias("__l_top"))
    top = top.select(*[F.col(k).alias(f"__l_{k}") for k in keys], "__l_top")
    cond = df[first].eqNullSafe(top["__l_top"])
    for k in keys:
        cond = cond & df[k].eqNullSafe(top[f"__l_{k}"])
    candidates = df.join(small_side(top), cond, "left_semi")
    picked = candidates.groupBy(*keys).agg(F.max_by(row, rank).alias("__row"))
    return picked.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in others])
