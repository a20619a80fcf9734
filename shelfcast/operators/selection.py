"""Exact order statistics of many columns at once, by digits.

``select_ranks`` finds the values at given ranks of 64-bit keys without a
sort: a round counts, for all columns in one aggregate, the keys by their
next ``DIGIT_BITS`` bits below the prefix already known (other keys are left
out by a join with the few open prefixes); the digit that holds the rank
extends the prefix.  At most six rounds read the input, fewer where
a prefix holds one distinct key.  Counts are combined partially in each task,
so a shuffle carries at most 2^``DIGIT_BITS`` rows a task and open rank, and no task
ever holds a column's distinct values.

``with_sortable`` maps doubles to keys in their order (the sign and the IEEE 754
bits, by arithmetic), so medians are those of the doubles themselves.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 12
_SHIFTS = (52, 40, 28, 16, 4, 0)
_SMALLEST, _LARGEST = -1022, 1023  # binary exponents of normal doubles
_INFINITE = 2047 << 52


def with_sortable(df: DataFrame, value: str, key: str) -> DataFrame:
    """``df`` with ``key``: a long in the order of the doubles of ``value``; rows of
    NULL and NaN are left out, both zeros have one key.

    The exponent and the scaled value are columns of their own, so that each
    is computed once a row.
    """
    size = F.abs(F.col(value))
    log = F.coalesce(F.log2(size), F.lit(float(_SMALLEST)))  # NULL for 0
    guess = F.floor(F.greatest(F.lit(float(_SMALLEST)), F.least(F.lit(float(_LARGEST)), log))).cast("int")
    part, e = F.col("__part"), F.col("__exponent")
    # The logarithm may be one off beside a power of two.
    low = (part < 1) & (e > _SMALLEST)
    normal = (
        F.when(part >= 2, F.shiftleft((e + 1 - _SMALLEST).cast("long"), 52) + (part * F.lit(2.0**51)).cast("long"))
        .when(low, F.shiftleft((e - 1 - _SMALLEST).cast("long"), 52) + (part * F.lit(2.0**53)).cast("long"))
        .otherwise(F.shiftleft((e - _SMALLEST).cast("long"), 52) + (part * F.lit(2.0**52)).cast("long"))
    )
    sign = F.when(F.col(value) < 0, F.lit(-1)).otherwise(F.lit(1))
    bits = F.when(size == F.lit(float("inf")), F.lit(_INFINITE)).otherwise(normal)
    return (
        df.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("__exponent", guess)
        .withColumn("__part", size / F.pow(F.lit(2.0), e))  # exact: a power of two divides
        .withColumn(key, sign * bits).drop("__exponent", "__part")
    )


def from_sortable(key: int) -> float:
    size = struct.unpack("<d", struct.pack("<q", abs(key)))[0]
    return -size if key < 0 else size


def select_ranks(cells: DataFrame, columns: int, ranks: Callable[[int, int], Iterable[int]]) -> list[tuple[int, dict[int, int]]]:
    """``cells``: rows (i, k) with a column number below ``columns`` and a long
    key.  For each column its number of non-NULL keys n, and rank -> key for
    the 0-based ranks that ``ranks(i, n)`` asks for."""
    cells = cells.select("i", "k").where(F.col("k").isNotNull())
    found: list[dict[int, int]] = [{} for _ in range(columns)]
    total = [0] * columns
    wanted: dict[tuple[int, int], dict[int, int]] = {}  # (column, prefix) -> rank -> rank within the prefix
    before = None
    for shift in _SHIFTS:
        digits = _count_digits(cells, before, shift, list(wanted))
        if before is None:
            for (i, _), rows in digits.items():
                total[i] = sum(n for _, n, _, _ in rows)
            wanted = {(i, 0): {r: r for r in ranks(i, n)} for i, n in enumerate(total) if n}
        narrowed: dict[tuple[int, int], dict[int, int]] = {}
        for (i, prefix), by_rank in wanted.items():
            for rank, within in by_rank.items():
                for digit, n, low, high in sorted(digits[i, prefix]):
                    if within < n:
                        break
                    within -= n
                if low == high:
                    found[i][rank] = low
                else:
                    narrowed.setdefault((i, digit), {})[rank] = within
        wanted, before = narrowed, shift
        if not wanted:
            break
    return list(zip(total, found, strict=True))


def _count_digits(cells: DataFrame, before: int | None, shift: int, prefixes: list[tuple[int, int]],
                  ) -> dict[tuple[int, int], list[tuple[int, int, int, int]]]:
    """(column, prefix) -> rows (prefix with the next digit, keys, smallest, largest),
    for the given prefixes (all keys in the first round, where the prefix is 0)."""
    if before is not None:
        small = cells.sparkSession.createDataFrame(prefixes, "i int, prefix long")  # at most a row for each open rank
        cells = cells.withColumn("prefix", F.shiftright("k", before)).join(F.broadcast(small), ["i", "prefix"], "left_semi")
    rows = cells.groupBy("i", F.shiftright("k", shift).alias("digit")).agg(F.count(F.lit(1)), F.min("k"), F.max("k"))
    out: dict[tuple[int, int], list[tuple[int, int, int, int]]] = {}
    found = rows.toDF("i", "digit", "n", "low", "high").toPandas()  # at most 2^DIGIT_BITS rows a prefix
    for i, digit, n, low, high in found.itertuples(index=False, name=None):
        out.setdefault((i, 0 if before is None else low >> before), []).append((digit, n, low, high))
    return out


def _middle(_: int, n: int) -> set[int]:
    return {(n - 1) // 2, n // 2}


def _cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (i, v): the numbered columns' values as doubles."""
    values = [F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)]
    return df.select(F.inline(F.array(*values)))


def exact_medians(df: DataFrame, columns: Iterable[str]) -> dict[str, float | None]:
    """Column -> median (the mean of the middle two of an even number), NULL and
    NaN left out; None for a column without values."""
    columns = list(columns)
    if not columns:
        return {}
    found = select_ranks(with_sortable(_cells(df, columns), "v", "k"), len(columns), _middle)
    return {c: sum(from_sortable(by_rank[r]) for r in sorted(_middle(0, n))) / len(_middle(0, n)) if n else None
            for c, (n, by_rank) in zip(columns, found, strict=True)}


def median_report(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column_name, n (values) and median, a row for each column."""
    columns = list(columns)
    found = [(i, c, m) for i, (c, m) in enumerate(exact_medians(df, columns).items())]
    counts = _cells(df, columns).groupBy("i").agg(F.count(F.when(F.col("v").isNotNull() & ~F.isnan("v"), 1)).alias("n"))
    names = df.sparkSession.createDataFrame(found, "i int, column_name string, median double")
    return names.join(counts, "i", "left").select("column_name", F.coalesce("n", F.lit(0)).alias("n"), "median")
