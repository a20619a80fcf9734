"""Malformed rows set aside, in batch and in the stream; columns bound by header."""

import os

from pyspark.sql import functions as F

from shelfcast.contracts import RAW_CONTRACTS
from shelfcast.sources.files import contract_read
from shelfcast.sources.quarantine import read_csv_checked
from shelfcast.streaming.landing import load_new_files

HEADER = "Store,Dept,Date,Weekly_Sales,IsHoliday"


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_torn_rows_are_set_aside(spark, scratch):
    path = write(f"{scratch}/sales.csv", HEADER, "1,2,2012-01-06,10.5,false", "1,3,2012-01-06", '2,3,"2012-01-06,1,true',
                 "4,5,2012-01-13,,TRUE", "1,2,3,4,5,6")
    good, bad = read_csv_checked(spark, path)
    assert good.count() == 2 and good.select("Dept").collect() == [("2",), ("5",)]
    reasons = {r.record: r.reason for r in bad.collect()}
    assert reasons["1,3,2012-01-06"] == "3 fields instead of 5" and reasons["1,2,3,4,5,6"] == "6 fields instead of 5"
    assert any("quote" in r for r in reasons.values()) and len(reasons) == 3
    rows = contract_read(spark, path, RAW_CONTRACTS["sales"], quarantine=f"{scratch}/aside").collect()
    assert sorted((r.store, r.weekly_sales, r.source_file) for r in rows) == [(1, 10.5, "sales.csv"), (4, None, "sales.csv")]
    aside = spark.read.parquet(f"{scratch}/aside")
    assert aside.count() == 3 and aside.where("source_file = 'sales.csv'").count() == 3


def test_stream_binds_columns_by_each_files_header(spark, scratch):
    base = f"{scratch}/landing/sales"
    write(f"{base}/a.csv", HEADER, "1,2,2/24/2012,10.5,false", "9,9")
    write(f"{base}/b.csv", "is holiday,Dept,Store,Weekly Sales,Date,Extra", "yes,7,8,3.5,2/17/2012,x", "", "no,7,8,,2/10/2012,y")
    table = f"{scratch}/raw_sales"
    load_new_files(spark, f"{scratch}/landing", "sales", table, f"{scratch}/ckpt")
    write(f"{base}/c.csv", "Date,Store,Dept,Weekly_Sales,IsHoliday", "2012-03-02,3,4,5.0,1", "2012-03-02,3")
    for _ in range(2):
        load_new_files(spark, f"{scratch}/landing", "sales", table, f"{scratch}/ckpt")
    got = spark.read.parquet(table)
    rows = [(r.store, r.dept, str(r.date), r.weekly_sales, r.is_holiday, r.source_file) for r in got.collect()]
    assert sorted(rows, key=lambda r: (r[0], r[2])) == [
        (1, 2, "2012-02-24", 10.5, False, "a.csv"), (3, 4, "2012-03-02", 5.0, True, "c.csv"),
        (8, 7, "2012-02-10", None, False, "b.csv"), (8, 7, "2012-02-17", 3.5, True, "b.csv")]
    aside = {(r.source_file, r.record): r.reason for r in spark.read.parquet(f"{table}_quarantine").collect()}
    assert aside == {("a.csv", "9,9"): "2 fields instead of 5", ("c.csv", "2012-03-02,3"): "2 fields instead of 5"}
    assert got.where(F.col("loaded_at").isNull()).count() == 0
