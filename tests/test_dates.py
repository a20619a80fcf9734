"""The vote over a column's date spellings."""

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from shelfcast.contracts import RAW_CONTRACTS, cast_to_contract
from shelfcast.sources.dates import ISO, SPELLINGS, parse_date, spellings, vote, vote_report
from shelfcast.sources.files import contract_read, write_csv


def column(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "d string").repartition(3)


def read(df):
    chosen = spellings(df, ["d"])["d"]
    return chosen, {r.d: r.p for r in df.select("d", parse_date(F.col("d"), chosen).alias("p")).collect()}


FEB5 = dt.date(2010, 2, 5)


@pytest.mark.parametrize("values, spelling, expected", [
    (["2/5/2010", "2/12/2010"], "month/day/year", FEB5),
    (["02/05/2010", "05/02/2010"], "month/day/year", FEB5),  # undecided: month first
    (["05/02/2010", "19/02/2010"], "day/month/year", FEB5),  # 19 can't be a month
    (["Feb 5, 2010", "Dec 31, 2010"], "mon day, year", FEB5),
    (["February 5, 2010", "May 1, 2010"], "month day, year", FEB5),
    (["5-Feb-2010", "31-Dec-2010"], "day-mon-year", FEB5),
    (["2010-02-05", "2010-02-12 00:00:00"], ISO, FEB5),
    (["20100205", "20101231"], "yearmonthday", FEB5),
    (["2/5/2010 0:00", "2/12/2010 13:45:10"], "month/day/year", FEB5),
    (["2/5/10", "2/28/10"], "month/day/yy", FEB5),
    ([" 2/5/2010 ", "2/28/2010"], "month/day/year", FEB5),
])
def test_spellings(spark, values, spelling, expected):
    chosen, got = read(column(spark, *values))
    assert chosen == spelling
    assert got[values[0]] == expected
    assert None not in got.values()


def test_majority_wins_and_the_rest_is_rejected(spark):
    df = column(spark, "2/5/2010", "2/12/2010", "2/19/2010", "2010-02-26", "bad", "2/30/2010", "NA", None, " ")
    v = vote(df, ["d"])["d"]
    assert (v.spelling, v.n_filled, v.n_parsed, v.n_rejected) == ("month/day/year", 6, 3, 3)
    assert vote_report(df, ["d", "absent"]).collect()[0].n_rejected == 3


def test_columns_without_a_readable_value(spark):
    df = spark.createDataFrame([(None, "x"), ("", "y")], "a string, b string")
    got = vote(df, ["a", "b"])
    assert (got["a"].spelling, got["a"].n_filled) == (ISO, 0) and (got["b"].spelling, got["b"].n_rejected) == (ISO, 2)
    empty = spark.createDataFrame([], "a string")
    assert vote(empty, ["a"])["a"].n_filled == 0 and vote(empty, []) == {}
    typed = spark.createDataFrame([(FEB5,)], "a date")
    assert spellings(typed, ["a"]) == {}


def test_every_spelling_reads_its_own_dates(spark):
    days = spark.sql("select explode(sequence(date'2009-01-01', date'2012-12-31', interval 13 days)) day")
    plain = {n: s.pattern.split("[")[0] for n, s in SPELLINGS.items()}
    texts = days.select("day", *[F.date_format("day", p).alias(n.replace(".", "_")) for n, p in plain.items()])
    for n in plain:
        c = n.replace(".", "_")

        assert texts.where(~parse_date(F.col(f"`{c}`"), n).eqNullSafe(F.col("day"))).count() == 0


def test_contract_read_votes_and_counts_what_it_rejects(spark, scratch):
    rows = [("1", "1", "05/02/2010", "10.5", "false"), ("1", "1", "19/02/2010", "11", "TRUE"), ("1", "2", "bad", "NA", "yes")]
    df = spark.createDataFrame(rows, "Store string, Dept string, Date string, Weekly_Sales string, IsHoliday string")
    write_csv(df, f"{scratch}/sales.csv")
    seen = Observation("rejected-dates")
    got = contract_read(spark, f"{scratch}/sales.csv", RAW_CONTRACTS["sales"], rejected=seen).collect()
    assert sorted(str(r.date) for r in got) == ["2010-02-05", "2010-02-19", "None"]
    assert seen.get == {"date": 1}
    fixed = cast_to_contract(df, RAW_CONTRACTS["sales"], date_spellings={"date": "month/day/year"})
    assert fixed.where(F.col("date") == F.lit("2010-05-02").cast("date")).count() == 1
