"""Order statistics by digits, against sorting."""

import math
import random
import statistics

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfcast.operators.selection import _SHIFTS, exact_medians, from_sortable, select_ranks, with_sortable


def test_keys_keep_order_and_value(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, -math.inf, 0.1, -0.1]
    values += [math.ldexp(m, e) for e in range(-1074, 1024, 7) for m in (1.0, 1.5)]
    values += [math.nextafter(math.ldexp(1.0, e), t) for e in range(-1022, 1024, 5) for t in (0.0, math.inf)]
    values += [rng.uniform(-1e6, 1e6) for _ in range(500)]
    got = spark.createDataFrame([(v,) for v in values], "v double")
    got = with_sortable(got, "v", "k").collect()
    assert len(got) == len(values) and all(from_sortable(r.k) == r.v for r in got)
    by_value = sorted(got, key=lambda r: r.v)
    assert all(a.k <= b.k and (a.k < b.k or a.v == b.v) for a, b in zip(by_value, by_value[1:]))
    assert with_sortable(spark.createDataFrame([(None,), (math.nan,)], "v double"), "v", "k").count() == 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.floats()), st.one_of(st.none(), st.integers(-3, 3).map(float))), max_size=40))
def test_medians_equal_sorting(spark, rows):
    df = spark.createDataFrame(rows, "a double, b double").repartition(3)
    got = exact_medians(df, ["a", "b"])
    for i, c in enumerate("ab"):
        held = sorted(r[i] for r in rows if r[i] is not None and not math.isnan(r[i]))
        want = statistics.median(held) if held else None
        assert got[c] == want or (want is not None and math.isnan(want) and math.isnan(got[c]))


def test_ranks_of_spread_keys_on_any_partitioning(spark):
    df = spark.range(20_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 7).alias("few"))
    keys = sorted(r.k for r in df.select("k").collect())
    for parts in (1, 5):
        cells = df.repartition(parts).select(F.inline(F.array(
            *[F.struct(F.lit(i).alias("i"), F.col(c).alias("k")) for i, c in enumerate(("k", "few"))])))
        k, few = select_ranks(cells, 2, lambda _, n: (0, n // 3, n - 1))
        assert k == (20_000, {r: keys[r] for r in (0, 6666, 19_999)})
        assert few == (20_000, {0: 0, 6666: 2, 19_999: 6})


def test_equal_keys_and_neighbours_in_the_last_bit(spark):
    rows = [(1.0,), (math.nextafter(1.0, 2.0),)] * 3 + [(1.0,)] * 2
    assert exact_medians(spark.createDataFrame(rows, "v double"), ["v"]) == {"v": 1.0}
    assert len(_SHIFTS) == 6 and exact_medians(spark.createDataFrame([], "v double"), ["v"]) == {"v": None}
    assert exact_medians(spark.createDataFrame([(1,), (4,)], "v int"), ["v"]) == {"v": 2.5}
    with pytest.raises(Exception):
        exact_medians(spark.createDataFrame([("x",)], "v string"), ["v"])
