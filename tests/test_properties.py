"""Property tests: Spark operators against brute force on random inputs."""

import datetime as dt
import math
import statistics

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shelfcast.functions.scalar import risk_category, stockout_score
from shelfcast.operators import features, scoring

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def py_class(score):
    if score is None or math.isnan(score) or math.isinf(score):
        return "Critical"
    return "Low" if score < 0.60 else "Medium" if score <= 0.90 else "High" if score <= 1.10 else "Critical"


def py_score(p, inv):
    if inv is None:
        return None
    if inv <= 0:
        return math.inf
    return None if p is None else p / inv


money = st.one_of(st.none(), st.integers(-10**9, 10**9).map(lambda c: c / 10000))


@SETTINGS
@given(st.lists(st.tuples(money, money), min_size=1, max_size=40))
def test_stockout_score_and_class(spark, rows):
    df = spark.createDataFrame(rows, "p double, inv double")
    got = df.select(stockout_score("p", "inv").alias("s")).select("s", risk_category("s").alias("c")).collect()
    for (p, inv), r in zip(rows, got):
        want = py_score(p, inv)
        assert (r["s"] is None and want is None) or r["s"] == want
        assert r["c"] == py_class(want)


@SETTINGS
@given(st.dictionaries(st.tuples(st.integers(1, 3), st.integers(1, 3)),
                       st.lists(money, min_size=1, max_size=12), min_size=1, max_size=5))
def test_group_zscores_match_numpy(spark, groups):
    rows = [(s, d, dt.date(2012, 1, 6) + dt.timedelta(days=7 * i), v)
            for (s, d), vals in groups.items() for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "store_id int, dept_id int, sales_date date, weekly_sales double")
    got = {(r["store_id"], r["dept_id"], r["sales_date"]): r["anomaly_score"]
           for r in scoring.detect_sales_anomalies(df, 2.0).collect()}
    for (s, d), vals in groups.items():
        present = [v for v in vals if v is not None]
        sd = statistics.pstdev(present) if present else None
        mean = statistics.fmean(present) if present else None
        for i, v in enumerate(vals):
            z = got[(s, d, dt.date(2012, 1, 6) + dt.timedelta(days=7 * i))]
            if not present or sd == 0 or max(present) == min(present):
                assert z == 0.0
            elif v is None:
                assert z is None
            else:
                assert math.isclose(z, (v - mean) / sd, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 2), st.integers(0, 2), st.integers(0, 3)),
                min_size=1, max_size=60), st.sampled_from([0.1, 0.2, 0.5]))
def test_chronological_split_matches_sorting(spark, rows, test_size):
    data = [(dt.date(2012, 1, 6) + dt.timedelta(days=7 * w), float(v), s, d) for w, s, d, v in rows]
    df = spark.createDataFrame(data, "date date, weekly_sales double, store int, dept int")
    sp = features.chronological_split(df, test_size)
    n = len(data)
    if n < 10:
        assert sp.train.count() == sp.test.count() == n
        return
    ordered = sorted(data, key=lambda r: (r[0], r[2], r[3], r[1]))
    k = features.split_index(n, test_size)
    assert sorted(map(tuple, sp.train.collect())) == sorted(ordered[:k])
    assert sorted(map(tuple, sp.test.collect())) == sorted(ordered[k:])
