"""Reading date columns by a vote of their spellings.

A source file spells the dates of a column in one way, but different files
spell them differently: ``2010-02-05``, ``2/5/2010``, ``05/02/2010``,
``Feb 5, 2010``.  One aggregate over the whole column counts how many values
each known spelling reads; the spelling that reads most becomes the column's
projection, and values it doesn't read are NULL (counted as rejected by the
job that writes them, see ``observe_rejected``).

Equal counts go to the spelling listed first: month before day, as the
reference reads ``05/02/2010``; a column whose values exceed 12 in front is
read day first.  A value is parsed only where its shape fits (month and day
numbers within their ranges), so misses cost a regular expression, not an
exception.  The vote counts each column's distinct values first (partially in
every task, so a frequent date is one row) and tries the spellings on those.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO = "iso"


@dataclass(frozen=True)
class Spelling:
    """``shape`` is what a value must match, ``pattern`` the datetime pattern that reads it."""

    name: str
    shape: str
    pattern: str


_CLOCK = r"( ([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d)?)?"
_TIME = "[ H:mm[:ss]]"
_M, _D, _Y, _YY = r"(0?[1-9]|1[0-2])", r"(0?[1-9]|[12]\d|3[01])", r"\d{4}", r"\d{2}"
# English names of the months.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
          "December")
_NAME = f"({'|'.join(MONTHS)})"
_MON = f"({'|'.join(m[:3] for m in MONTHS)})"
# In the order that decides equal counts.
SPELLINGS: dict[str, Spelling] = {
    s.name: s
    for s in (
        Spelling("month/day/year", f"{_M}/{_D}/{_Y}{_CLOCK}", f"M/d/yyyy{_TIME}"),
        Spelling("day/month/year", f"{_D}/{_M}/{_Y}{_CLOCK}", f"d/M/yyyy{_TIME}"),
        Spelling("month-day-year", f"{_M}-{_D}-{_Y}{_CLOCK}", f"M-d-yyyy{_TIME}"),
        Spelling("day-month-year", f"{_D}-{_M}-{_Y}{_CLOCK}", f"d-M-yyyy{_TIME}"),
        Spelling("day.month.year", rf"{_D}\.{_M}\.{_Y}{_CLOCK}", f"d.M.yyyy{_TIME}"),
        Spelling("year/month/day", f"{_Y}/{_M}/{_D}{_CLOCK}", f"yyyy/M/d{_TIME}"),
        Spelling("yearmonthday", rf"{_Y}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])", "yyyyMMdd"),
        Spelling("mon day, year", f"{_MON} {_D}, {_Y}", "MMM d, yyyy"),
        Spelling("month day, year", f"{_NAME} {_D}, {_Y}", "MMMM d, yyyy"),
        Spelling("day mon year", f"{_D} {_MON} {_Y}", "d MMM yyyy"),
        Spelling("day month year", f"{_D} {_NAME} {_Y}", "d MMMM yyyy"),
        Spelling("day-mon-year", f"{_D}-{_MON}-{_Y}", "d-MMM-yyyy"),
        Spelling("month/day/yy", f"{_M}/{_D}/{_YY}", "M/d/yy"),
        Spelling("day/month/yy", f"{_D}/{_M}/{_YY}", "d/M/yy"),
    )
}
# Words that stand for a missing value (lower case).
MISSING_WORDS = ("", "na", "n/a", "nan", "nat", "null", "none")


def _filled(col: Column) -> Column:
    """The value without white space around it, NULL for a missing one."""
    text = F.trim(col.cast("string"))
    return F.when(~F.lower(text).isin(*MISSING_WORDS), text)


def parse_date(col: Column, spelling: str = ISO) -> Column:
    """The date of a text in one spelling, else NULL."""
    text = F.trim(col.cast("string"))
    if spelling == ISO:
        return F.coalesce(text.try_cast("date"), F.try_to_timestamp(text).cast("date"))
    s = SPELLINGS[spelling]
    return F.when(text.rlike(f"^{s.shape}$"), F.try_to_timestamp(text, F.lit(s.pattern)).cast("date"))


@dataclass(frozen=True)
class DateVote:
    """What the vote over one column found."""

    column: str
    spelling: str
    n_filled: int
    n_parsed: int

    @property
    def n_rejected(self) -> int:
        return self.n_filled - self.n_parsed


def vote(df: DataFrame, columns: Iterable[str]) -> dict[str, DateVote]:
    """The winning spelling of each text column, from one aggregate over all rows.

    A column without a readable value keeps the ISO spelling.
    """
    columns = list(columns)
    if not columns:
        return {}
    names = (ISO, *SPELLINGS)
    values = F.array(*[F.struct(F.lit(i).alias("i"), _filled(F.col(c)).alias("v")) for i, c in enumerate(columns)])
    distinct = (
        df.select(F.inline(values)).where(F.col("v").isNotNull()).groupBy("i", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = distinct.groupBy("i").agg(
        F.sum("n").alias("filled"),
        F.array(*[F.coalesce(F.sum(F.when(parse_date(F.col("v"), n).isNotNull(), F.col("n"))), F.lit(0)) for n in names]).alias("parsed"),
    )
    found = {r["i"]: r for r in counts.collect()}  # a row for each column
    out = {}
    for i, c in enumerate(columns):
        filled, parsed = (found[i]["filled"], found[i]["parsed"]) if i in found else (0, [0] * len(names))
        best = max(range(len(names)), key=lambda j: (parsed[j], -j))
        out[c] = DateVote(c, names[best], filled, parsed[best])
    return out


def text_dates(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of the columns that hold text (typed dates need no vote)."""
    return [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]


def spellings(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    """Column -> winning spelling, for the text columns among ``columns``."""
    return {c: v.spelling for c, v in vote(df, text_dates(df, columns)).items()}


def observe_rejected(df: DataFrame, chosen: Mapping[str, str], observation: Observation) -> DataFrame:
    """``df`` (text dates) with its rejected values counted, by column, while it is written."""
    rejected = [
        F.count_if(_filled(F.col(c)).isNotNull() & parse_date(F.col(c), s).isNull()).alias(c) for c, s in chosen.items()
    ]
    return df.observe(observation, *rejected) if rejected else df


def vote_report(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """column_name, spelling, n_filled, n_parsed, n_rejected: a row for each text date column."""
    rows = [(v.column, v.spelling, v.n_filled, v.n_parsed, v.n_rejected) for v in vote(df, text_dates(df, columns)).values()]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, spelling string, n_filled long, n_parsed long, n_rejected long")
