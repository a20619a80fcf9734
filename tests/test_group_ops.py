"""Skew-safe group operators against brute force on small frames."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.operators import features
from shelfcast.plans.groups import latest_per_group, previous_in_group


def _frame(spark, n_groups=6, weeks=160, seed=3):
    rnd = random.Random(seed)
    rows = []
    for g in range(n_groups):
        for w in range(weeks):
            if rnd.random() < 0.15:
                continue  # gaps, including whole years for some groups
            rows.append((g % 3, g, dt.date(2009, 1, 2) + dt.timedelta(days=7 * w), rnd.choice([None, rnd.random() * 100])))
    return spark.createDataFrame(rows, "store_id int, dept_id int, sales_date date, weekly_sales double")


def test_previous_in_group_equals_window_lag(spark):
    df = _frame(spark)
    keys = ["store_id", "dept_id"]
    got = previous_in_group(df, keys, ["sales_date", "weekly_sales"], "weekly_sales", "prev", F.year("sales_date"))
    want = df.withColumn("prev", F.lag("weekly_sales").over(Window.partitionBy(*keys).orderBy("sales_date")))
    assert got.select(*df.columns, "prev").exceptAll(want).count() == 0
    assert got.count() == df.count()


def test_previous_in_group_date_chunks_with_hot_group_and_ties(spark):
    rnd = random.Random(11)
    rows = []
    for w in range(60):  # group (0, 0) holds most rows, several per date, some tied
        d = dt.date(2010, 12, 3) + dt.timedelta(days=7 * w)
        for _ in range(rnd.randint(1, 6)):
            rows.append((0, 0, d, rnd.choice([None, 1.0, 2.0, rnd.random() * 100])))
    rows += [(1, 2, dt.date(2011, 1, 7) + dt.timedelta(days=7 * w), float(w)) for w in range(0, 30, 3)]
    rows += [(None, 2, dt.date(2011, 1, 7), 5.0), (None, 2, dt.date(2011, 1, 14), 6.0), (1, 2, None, 7.0)]
    df = spark.createDataFrame(rows, "store_id int, dept_id int, sales_date date, weekly_sales double")
    keys = ["store_id", "dept_id"]
    order = ["sales_date", "weekly_sales"]
    want = df.withColumn("prev", F.lag("weekly_sales").over(Window.partitionBy(*keys).orderBy(*order)))
    for chunk in (F.col("sales_date"), None):  # min_by path and the plain-aggregate path
        got = previous_in_group(df, keys, order, "weekly_sales", "prev", chunk)
        assert got.count() == df.count()
        assert got.select(*df.columns, "prev").exceptAll(want).count() == 0


def test_latest_per_group(spark):
    df = _frame(spark)
    got = latest_per_group(df, ["store_id", "dept_id"], ["sales_date", "weekly_sales"])
    w = Window.partitionBy("store_id", "dept_id").orderBy(F.col("sales_date").desc())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert got.select(*df.columns).exceptAll(want).count() == 0 and got.count() == want.count()


def test_latest_per_group_nulls_ties_and_hot_group(spark):
    d = dt.date(2012, 3, 2)
    rows = [(1, 1, d + dt.timedelta(days=7 * (i % 9)), float(i % 4)) for i in range(300)]  # hot group, ties
    rows += [(1, 2, None, 3.0), (1, 2, None, 1.0), (None, 2, d, 5.0), (None, 2, None, 9.0), (2, None, None, None)]
    rows += [(3, 3, d, None), (3, 3, d, 2.0), (3, 3, None, 8.0)]
    df = spark.createDataFrame(rows, "store_id int, dept_id int, sales_date date, weekly_sales double")
    w = Window.partitionBy("store_id", "dept_id").orderBy(F.col("sales_date").desc(), F.col("weekly_sales").desc())
    want = df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    for narrow in (True, False):
        got = latest_per_group(df, ["store_id", "dept_id"], ["sales_date", "weekly_sales"], narrow=narrow)
        assert got.count() == want.count() == 5
        assert got.select(*df.columns).exceptAll(want).count() == 0


def test_chronological_split_matches_sort(spark):
    rows = [(dt.date(2012, 1, 6) + dt.timedelta(days=7 * (i % 5)), float(i), i % 4, i % 3) for i in range(37)]
    df = spark.createDataFrame(rows, "date date, weekly_sales double, store int, dept int")
    sp = features.chronological_split(df, 0.2)
    ordered = sorted(rows, key=lambda r: (r[0], r[2], r[3], r[1]))
    k = features.split_index(len(rows), 0.2)
    assert sp.train_rows == k == 29
    assert sorted(map(tuple, sp.train.collect())) == sorted(ordered[:k])
    assert sorted(map(tuple, sp.test.collect())) == sorted(ordered[k:])


def test_chronological_split_hot_boundary_key_ranked_over_many_tasks(spark):
    rnd = random.Random(5)
    d0 = dt.date(2012, 1, 6)
    rows = [(d0, rnd.choice([None, 1.0, 2.0, rnd.random()]), 1, 1) for _ in range(400)]  # one hot key
    rows += [(d0 - dt.timedelta(days=7), float(i), i % 3, 0) for i in range(40)]
    rows += [(d0 + dt.timedelta(days=7), float(i), 2, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "date date, weekly_sales double, store int, dept int")
    sp = features.chronological_split(df, 0.3, one_task_rows=50)
    key = lambda r: (r[0], r[2], r[3], r[1] is not None, r[1] or 0.0)  # NULLs first, as Spark sorts
    ordered = sorted(rows, key=key)
    k = features.split_index(len(rows), 0.3)
    assert sp.train_rows == k and sp.test_rows == len(rows) - k
    assert sorted(map(tuple, sp.train.collect()), key=key) == ordered[:k]
    assert sorted(map(tuple, sp.test.collect()), key=key) == ordered[k:]


def test_split_sizes():
    assert features.split_index(10, 0.2) == 8
    assert features.split_index(11, 0.99) == 1
    assert features.split_index(11, 0.0) == 10


def test_year_rollover(spark):
    df = spark.createDataFrame([(dt.date(2012, 12, 28), 1.0, 1, 1)], "date date, weekly_sales double, store int, dept int")
    df = df.select("*", *[v.alias(k) for k, v in features.calendar_columns("date").items()])
    r = features.next_week_rows(df).first()
    assert (r["date"], r["week_of_year"], r["year"]) == (dt.date(2013, 1, 4), 1, 2013)
