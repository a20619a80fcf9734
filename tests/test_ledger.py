"""Repeatable loads: reruns, failures, changed files, replacement."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.contracts import RAW_CONTRACTS
from shelfcast.plans.refresh import load_raw
from shelfcast.sources import ledger
from shelfcast.sources.files import contract_read, write_csv

SALES = RAW_CONTRACTS["sales"]


def land(spark, path, *rows):
    df = spark.createDataFrame([(str(s), "1", "2012-01-06", str(v), "false") for s, v in rows],
                               "Store string, Dept string, Date string, Weekly_Sales string, IsHoliday string")
    write_csv(df, path)
    return path


def load(spark, table, paths, read=None, **kw):
    return ledger.load_files(spark, "raw_t", table, SALES.table_schema, paths,
                             read or (lambda p: contract_read(spark, p, SALES)), **kw)


def stores(spark, table):
    return sorted(r.store for r in spark.table(f"raw_t.{table}").collect())


def test_rerun_adds_nothing_and_new_files_append(spark, scratch):
    a, b = land(spark, f"{scratch}/a.csv", (1, 2.5), (2, 3.5)), land(spark, f"{scratch}/b 'x'=1.csv", (3, 1.0))
    assert sum(load(spark, "again", [a]).values()) == 2
    assert load(spark, "again", [a]) == {}
    assert sum(load(spark, "again", [a, b]).values()) == 1
    assert stores(spark, "again") == [1, 2, 3]
    rows = {r.file_name: r for r in ledger.ledger(spark, "raw_t", "again").collect()}
    assert rows["a.csv"].row_count == 2 and rows["a.csv"].file_size > 0 and len(rows) == 2


def test_failed_load_leaves_the_table(spark, scratch):
    a, b = land(spark, f"{scratch}/a.csv", (1, 2.5)), land(spark, f"{scratch}/b.csv", (2, 3.5))
    load(spark, "failing", [a])

    def broken(path):
        return contract_read(spark, path, SALES).withColumn(
            "weekly_sales", F.when(F.col("store") == 2, F.raise_error(F.lit("torn"))).cast("double"))

    for _ in range(2):
        with pytest.raises(Exception, match="torn"):
            load(spark, "failing", [a, b], broken)
        assert stores(spark, "failing") == [1]
    load(spark, "failing", [a, b])
    assert stores(spark, "failing") == [1, 2]


def test_changed_file_and_replacement(spark, scratch):
    a = land(spark, f"{scratch}/a.csv", (1, 2.5))
    load(spark, "changed", [a])
    land(spark, a, (1, 2.5), (4, 4.5))
    load(spark, "changed", [a])
    assert stores(spark, "changed") == [1, 1, 4]
    assert load(spark, "changed", [a], replace=True) == {}
    assert stores(spark, "changed") == [1, 4]
    b = land(spark, f"{scratch}/b.csv", (9, 1.0))
    assert sum(load(spark, "changed", [b], replace=True).values()) == 1
    assert stores(spark, "changed") == [9]


def test_checksums_see_content_not_layout(spark, scratch):
    rows = [(i, float(i)) for i in range(50)]
    a, b = land(spark, f"{scratch}/x/a.csv", *rows), f"{scratch}/y/a.csv"
    land(spark, b, *rows[:-1], (49, 48.5))
    one, two, same = ledger.fingerprint(spark, [a, b, a])
    assert one == same and one.key != two.key and one.size == two.size
    empty = f"{scratch}/empty.csv"
    spark.createDataFrame([], "a string").write.text(empty)
    assert ledger.fingerprint(spark, [empty])[0].size == 0 and ledger.fingerprint(spark, []) == []


def test_load_raw_by_the_ledger(spark, scratch):
    land(spark, f"{scratch}/sales.csv", (1, 2.5))
    at = dt.datetime(2024, 1, 1)
    spark.sql("DROP TABLE IF EXISTS raw.sales")
    assert load_raw(spark, scratch, ["sales"], False, at, repeatable=True) == {"sales": 1}
    assert load_raw(spark, scratch, ["sales"], False, at, repeatable=True) == {"sales": 0}
    assert spark.table("raw.sales").count() == 1
    spark.sql("DROP TABLE raw.sales")


def test_existing_table_must_fit(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS raw_t")
    spark.sql("CREATE TABLE IF NOT EXISTS raw_t.other (a INT) USING parquet")
    with pytest.raises(ValueError, match="lacks columns"):
        load(spark, "other", [])
