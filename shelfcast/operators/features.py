"""Model-ready frames: training frame, next-week rows, chronological split.

C1 (with B17, B18, B27), E3 and E4.  Frames use the raw contract names
(``store``, ``dept``, ``date``...).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import truthy
from ..functions.scalar import calendar_columns, money_sum
from ..plans.groups import latest_per_group
from ..plans.joins import small_side

TARGET = "weekly_sales"
# Model feature columns, in model order.
FEATURE_COLUMNS = (
    "store", "dept", "temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
    "cpi", "unemployment", "is_holiday", "store_type", "size", "year", "month", "week_of_year", "day_of_year",
)
CATEGORICAL = ("store_type",)
NUMERIC = tuple(c for c in FEATURE_COLUMNS if c not in CATEGORICAL)
KEYS = ["store", "dept"]
NEXT_WEEK_DAYS = 7


def training_frame(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """Sales LEFT features (store, date) LEFT stores (store), cleaned.

    Holiday: the sales flag, else the feature flag, as a truthy word; NULL is
    false (B18).  Rows without store, dept, date or target are dropped
    before the calendar is derived (B27, T13).  Absent markdowns are 0, other
    absent measures NULL.
    """
    s = sales.select("store", "dept", "date", TARGET, F.col("is_holiday").alias("s_is_holiday"))
    f = features
    for m in ("markdown1", "markdown2", "markdown3", "markdown4", "markdown5"):
        if m not in f.columns:
            f = f.withColumn(m, F.lit(0.0))
    for m in ("temperature", "fuel_price", "cpi", "unemployment"):
        if m not in f.columns:
            f = f.withColumn(m, F.lit(None).cast("double"))
    if "is_holiday" not in f.columns:
        f = f.withColumn("is_holiday", F.lit(None).cast("boolean"))
    f = f.select(
        F.col("store").alias("f_store"), F.col("date").alias("f_date"), "temperature", "fuel_price", "markdown1",
        "markdown2", "markdown3", "markdown4", "markdown5", "cpi", "unemployment",
        F.col("is_holiday").alias("f_is_holiday"),
    )
    st = small_side(stores.select(F.col("store").alias("st_store"), "store_type", "size"))
    j = s.join(f, (s.store == f.f_store) & (s.date == f.f_date), "left").join(st, F.col("store") == F.col("st_store"), "left")
    j = j.dropna(subset=["store", "dept", "date", TARGET])
    holiday = truthy(F.coalesce(F.col("s_is_holiday").cast("string"), F.col("f_is_holiday").cast("string")))
    cal = calendar_columns("date")
    return j.select(
        "date", TARGET, "store", "dept", "temperature", "fuel_price", "markdown1", "markdown2", "markdown3",
        "markdown4", "markdown5", "cpi", "unemployment", holiday.alias("is_holiday"), "store_type", "size",
        *[v.alias(k) for k, v in cal.items()],
    )


def next_week_rows(frame: DataFrame) -> DataFrame:
    """Latest row per (store, dept), dated a week later, calendar recomputed;
    every other feature is carried over from that week (E3, T15).  The
    frame is a join, so it is aggregated in one pass, not narrowed first."""
    latest = latest_per_group(frame, KEYS, ["date", TARGET], narrow=False)
    moved = latest.withColumn("date", F.date_add("date", NEXT_WEEK_DAYS))
    for k, v in calendar_columns("date").items():
        moved = moved.withColumn(k, v)
    return moved.select(*frame.columns)


def next_week_from(sales: DataFrame, stores: DataFrame, features: DataFrame) -> DataFrame:
    """``next_week_rows`` of the training frame, of stored tables.

    Each group's latest date comes from the sales alone, so only the rows at
    it are joined with features and stores.
    """
    able = sales.dropna(subset=[*KEYS, "date", TARGET])
    top = able.groupBy(*KEYS).agg(F.max("date").alias("__top"))
    top = top.select(*[F.col(k).alias(f"__{k}") for k in KEYS], "__top")
    latest = [F.col(k) == F.col(f"__{k}") for k in KEYS] + [F.col("date") == F.col("__top")]
    return next_week_rows(training_frame(able.join(small_side(top), latest, "left_semi"), stores, features))


@dataclass
class Split:
    train: DataFrame
    test: DataFrame
    train_rows: int
    test_rows: int


def split_index(n: int, test_size: float) -> int:
    """Rows in the training part: int(n * (1 - test_size)), kept in [1, n - 1]."""
    return min(max(1, int(n * (1 - test_size))), n - 1)


# Rows of the boundary key that one task of the range-partitioned sort takes.
ONE_TASK_ROWS = 2_000_000


def global_rank(df: DataFrame, cols: list[str], rows: int, per_task: int = ONE_TASK_ROWS) -> DataFrame:
    """``df`` with ``__rn``, the 1-based position of each row in the order of
    ``cols`` (ascending, NULLs first), without one task holding all rows.

    Rows are range-partitioned on ``cols`` and sorted inside each partition;
    the sorted frame, tagged with ``monotonically_increasing_id`` (partition
    index in the upper bits, position below), is checkpointed so the
    partition bounds stay fixed; the per-partition counts (one row per
    partition) give each partition's offset.  Rows equal in all of ``cols``
    are interchangeable.
    """
    from ..session import cut_lineage

    parts = max(2, -(-rows // per_task) * 2)
    order = [F.col(c).asc_nulls_first() for c in cols]
    tagged = cut_lineage(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    pid = F.shiftright(F.col("__id"), 33)
    counts = dict(tuple(r) for r in tagged.groupBy(pid.alias("p")).count().collect())
    offsets, run = [], 0
    for p in range(max(counts, default=-1) + 1):  # empty partitions have no count
        offsets.append(run)
        run += counts.get(p, 0)
    table = F.array(*[F.lit(o).cast("bigint") for o in offsets]) if offsets else F.array(F.lit(0).cast("bigint"))
    offset = F.element_at(table, (pid + F.lit(1)).cast("int"))
    pos = F.col("__id") - F.shiftleft(pid, 33)
    return tagged.withColumn("__rn", offset + pos + F.lit(1)).drop("__id")


def chronological_split(frame: DataFrame, test_size: float = 0.2, min_rows: int = 10,
                        one_task_rows: int = ONE_TASK_ROWS) -> Split:
    """First ``int(n * (1 - test_size))`` rows by (date, store, dept, rest) train.

    No global sort or single-partition window.  The boundary is found by
    descending one ordering column at a time: a histogram of dates (one row
    per date) gives the boundary date, a histogram of stores within that
    date the boundary store, a histogram of departments within that store
    the boundary key.  Each collected histogram is bounded by one
    dimension's cardinality.  Only the rows of the one boundary key are
    ranked, by ``global_rank`` with ``one_task_rows`` rows a task.  Under ``min_rows`` rows both parts are
    the whole frame.
    """
    order = ["date", *KEYS]
    need, fixed, n, b_rows = None, [], None, 0
    for col in order:
        scope = frame
        for c, v in fixed:
            scope = scope.where(F.col(c) == F.lit(v))
        hist = sorted(scope.groupBy(col).count().collect(), key=lambda r: r[col])
        if n is None:
            n = sum(r["count"] for r in hist)
            if n < min_rows:
                return Split(frame, frame, n, n)
            need = split_index(n, test_size)
        before = 0
        for row in hist:
            if before + row["count"] >= need:
                fixed.append((col, row[col]))
                b_rows = row["count"]
                need -= before
                break
            before += row["count"]
    k = split_index(n, test_size)

    key = F.struct(*[F.col(c) for c in order])
    b_key = F.struct(*[F.lit(v).alias(c) for c, v in fixed])
    is_boundary = key == b_key
    ranked = global_rank(frame.where(is_boundary), frame.columns, b_rows, one_task_rows)
    train = frame.where(key < b_key).unionByName(ranked.where(F.col("__rn") <= need).drop("__rn"))
    test = frame.where(key > b_key).unionByName(ranked.where(F.col("__rn") > need).drop("__rn"))
    return Split(train, test, k, n - k)


def split_report(frame: DataFrame, test_size: float = 0.2, min_rows: int = 10) -> DataFrame:
    """What is on each side of ``chronological_split``: rows, dates, and sums of
    the keys and of the target."""
    split = chronological_split(frame, test_size, min_rows)
    sides = [part.select(F.lit(name).alias("side"), "date", *KEYS, TARGET) for name, part in (("train", split.train), ("test", split.test))]
    return sides[0].unionByName(sides[1]).groupBy("side").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum(F.col("store") * 1000 + F.col("dept")).alias("key_sum"), money_sum(TARGET).alias("total_sales"))


def split_summary(frame: DataFrame, test_size: float = 0.2, min_rows: int = 10) -> DataFrame:
    """Sizes and date spans of the two parts, one row (E4 report).

    Both follow from the histogram of dates (one row per date, so bounded by
    the calendar): the parts' rows are not ranked for it.
    """
    hist = sorted(frame.groupBy("date").count().collect(), key=lambda r: r["date"])
    n = sum(r["count"] for r in hist)
    train, test = (n, n) if n < min_rows else (split_index(n, test_size), n - split_index(n, test_size))
    spans, run = {"train": [], "test": []}, 0
    for row in hist:
        if run < train:
            spans["train"].append(row["date"])
        if n < min_rows or run + row["count"] > train:
            spans["test"].append(row["date"])
        run += row["count"]
    first, last = ({k: (v[i] if v else None) for k, v in spans.items()} for i in (0, -1))
    return frame.sparkSession.createDataFrame(
        [(train, first["train"], last["train"], test, first["test"], last["test"])],
        "training_rows long, train_start date, train_end date, validation_rows long, validation_start date, validation_end date")
