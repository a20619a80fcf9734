"""Raw retail tables derived from the TPC-H-style test tables.

The engine's own inputs are weekly store x department sales, store,
feature and inventory files.  The test data holds TPC-H-style tables, so
this module derives the four raw tables from them with plain DataFrame
operations (joins + grouped aggregation), in the raw landing contracts of
``contracts.RAW_CONTRACTS``:

* sales      lineitem x supplier x part, grouped by (supplier nation,
             part size bucket, ISO week of the ship date)
* stores     one store per nation
* features   orders x customer, grouped by (customer nation, order week)
* inventory  a deterministic function of each sales row, some rows left out

Money is multiplied and summed exactly (integer units of 1e-4) and turned
into a double once, at the end.  The adapter's work grows with lineitem/orders: both big joins are
left to the optimizer (shuffle joins at scale, broadcast when the planner's
size check allows), and the weekly grouping is partially aggregated before
its shuffle.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the adapter mapping.
HOLIDAY_WEEKS = (6, 36, 47, 52)
DEPT_BUCKETS = 10
INVENTORY_EPOCH = "1995-01-02"  # a Monday; week numbers count from it
ZERO_INVENTORY_MODULUS = 97
MISSING_INVENTORY_MODULUS = 23
COVERAGE_BASE, COVERAGE_MODULUS = 35, 171
SAFETY_FACTOR, REORDER_FACTOR = 0.25, 0.6

# Load stamps of adapter-derived raw rows: fixed so repeated runs agree.
ADAPTER_LOADED_AT = _dt.datetime(2024, 1, 1, 0, 0, 0)


def _stamp(df: DataFrame, entity: str) -> DataFrame:
    return df.withColumn("source_file", F.lit(f"a_{entity}")).withColumn(
        "loaded_at", F.lit(ADAPTER_LOADED_AT).cast("timestamp_ntz")
    )


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _week(col: str) -> F.Column:
    return F.date_trunc("week", F.col(col)).cast("date")


def _holiday(week_start: F.Column) -> F.Column:
    return F.weekofyear(week_start).isin(*HOLIDAY_WEEKS)


def sales_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly typed sales: (store_id, dept_id, sales_date, weekly_sales, is_holiday)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_discount", "l_shipdate")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    pa = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    # Revenue in units of 1e-4: cents times whole discount percents, an exact
    # integer.  The per-group BIGINT sum is exact (ANSI mode raises on
    # overflow; weekly group totals stay far below it) and aggregates with
    # primitive buffers, unlike a wide-decimal sum; dividing the exact total
    # by 10^4 once gives the correctly rounded double.
    revenue = F.round(F.col("l_extendedprice") * 100).cast("bigint") * (
        F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint")
    )
    joined = li.join(su, F.col("l_suppkey") == F.col("s_suppkey")).join(pa, F.col("l_partkey") == F.col("p_partkey"))
    weekly = joined.groupBy(
        F.col("s_nationkey").alias("store_id"),
        (F.col("p_size") % DEPT_BUCKETS + 1).alias("dept_id"),
        _week("l_shipdate").alias("sales_date"),
    ).agg((F.sum(revenue).cast("double") / F.lit(10000.0)).alias("weekly_sales"))
    return weekly.withColumn("is_holiday", _holiday(F.col("sales_date")))


def stores_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    na = read_table(spark, sf_dir, "nation")
    return na.select(
        F.col("n_nationkey").alias("store_id"),
        F.expr("chr(65 + n_regionkey % 3)").alias("store_type"),
        (F.lit(100000) + F.col("n_nationkey") * 4000).alias("store_size"),
    )


def features_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    cu = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = od.join(cu, F.col("o_custkey") == F.col("c_custkey"))

    def count_if(cond: F.Column) -> F.Column:
        return F.count(F.when(cond, 1))

    markdowns = {
        f"markdown{k}": F.lit(100.0) * count_if(F.col("o_orderpriority").startswith(str(k))) for k in range(1, 6)
    }
    grouped = joined.groupBy(
        F.col("c_nationkey").alias("store_id"), _week("o_orderdate").alias("feature_date")
    ).agg(
        (F.lit(20) + F.lit(10) * count_if(F.col("o_orderstatus") == "O")).cast("double").alias("temperature"),
        (F.lit(2.0) + F.count(F.lit(1)) / F.lit(4.0)).alias("fuel_price"),
        *[v.alias(k) for k, v in markdowns.items()],
    )
    return grouped.select(
        "store_id", "feature_date", "temperature", "fuel_price", *markdowns,
        (F.lit(200) + F.month("feature_date")).cast("double").alias("cpi"),
        F.when(F.col("store_id") % 6 != 0, F.lit(5) + F.col("store_id") % 4).cast("double").alias("unemployment"),
        _holiday(F.col("feature_date")).alias("is_holiday"),
    )


def inventory_frame(sales: DataFrame) -> DataFrame:
    """Deterministic inventory snapshot per sales row; some rows have none."""
    wk = (F.datediff(F.col("sales_date"), F.lit(INVENTORY_EPOCH).cast("date")) / 7).cast("int")
    w = sales.withColumn("wk", wk)
    coverage = (
        F.lit(COVERAGE_BASE) + (F.col("store_id") * 31 + F.col("dept_id") * 17 + F.col("wk") * 13) % COVERAGE_MODULUS
    ).cast("decimal(4,0)")
    available = F.when(
        (F.col("store_id") * 5 + F.col("dept_id") * 3 + F.col("wk")) % ZERO_INVENTORY_MODULUS == 0, F.lit(0.0)
    ).otherwise((F.col("weekly_sales").cast("decimal(16,4)") * coverage).cast("double") / F.lit(100.0))
    return w.where((F.col("store_id") * 7 + F.col("dept_id") * 11 + F.col("wk")) % MISSING_INVENTORY_MODULUS != 0).select(
        "store_id", "dept_id", F.col("sales_date").alias("inventory_date"),
        F.concat(F.lit("SKU-"), F.col("store_id").cast("string"), F.lit("-"), F.col("dept_id").cast("string")).alias("sku"),
        available.alias("available_inventory"),
        (F.col("weekly_sales") * F.lit(SAFETY_FACTOR)).alias("safety_stock_units"),
        (F.col("weekly_sales") * F.lit(REORDER_FACTOR)).alias("reorder_point_units"),
    )


def raw_tables(spark: SparkSession, sf_dir: str, materialize=None) -> dict[str, DataFrame]:
    """The four raw landing tables in raw contract shape (lazy).

    ``materialize`` (e.g. a checkpoint into the shared checkpoint folder)
    stores the two aggregates over the big tables (weekly sales from the
    lineitem joins, before inventory is derived from it; features from the
    orders join): the raw tables then read stored data, as the loaded raw
    tables of a refreshed warehouse do.
    """
    sales = sales_frame(spark, sf_dir)
    if materialize:
        sales = materialize(sales)
    raw_sales = _stamp(
        sales.select(
            F.col("store_id").alias("store"), F.col("dept_id").alias("dept"), F.col("sales_date").alias("date"),
            "weekly_sales", "is_holiday",
        ),
        "sales",
    )
    raw_stores = _stamp(
        stores_frame(spark, sf_dir).select(
            F.col("store_id").alias("store"), "store_type", F.col("store_size").cast("bigint").alias("size")
        ),
        "stores",
    )
    feat = features_frame(spark, sf_dir)
    raw_features = _stamp(
        feat.select(
            F.col("store_id").alias("store"), F.col("feature_date").alias("date"),
            *[c for c in feat.columns if c not in ("store_id", "feature_date")],
        ),
        "features",
    )
    inv = inventory_frame(sales)
    raw_inventory = _stamp(
        inv.select(
            F.col("store_id").alias("store"), F.col("dept_id").alias("dept"), F.col("inventory_date").alias("date"),
            "sku", "available_inventory", "safety_stock_units", "reorder_point_units",
        ),
        "inventory",
    )
    if materialize:
        # sales and inventory are now projections of the stored aggregate and
        # stores a projection of a 25-row scan; only the features aggregate
        # (orders x customer) still needs storing.
        raw_features = materialize(raw_features)
    return {"sales": raw_sales, "stores": raw_stores, "features": raw_features, "inventory": raw_inventory}


# Dirty string-typed source rows for the prepare step: adapter rows as text,
# with some values replaced by a rule on the key (fixed moduli).
DIRTY_NA, DIRTY_DATE, DIRTY_WORD, DIRTY_TEMP = 13, 17, 19, 11


def _weeks(date_col: str) -> F.Column:
    return (F.datediff(F.col(date_col), F.lit(INVENTORY_EPOCH).cast("date")) / 7).cast("int")


def dirty_sales_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as a source CSV would deliver it: text columns, source headers,
    dates as 2/5/2010, 'NA' sales, unparseable dates and 'yes' holiday words on
    some rows."""
    s = sales_frame(spark, sf_dir)
    r = F.col("store_id") * 31 + F.col("dept_id") * 7 + _weeks("sales_date")
    return s.select(
        F.col("store_id").cast("string").alias("Store"),
        F.col("dept_id").cast("string").alias("Dept"),
        F.when(r % DIRTY_DATE == 0, F.lit("bad")).otherwise(F.date_format("sales_date", "M/d/yyyy")).alias("Date"),
        F.when(r % DIRTY_NA == 0, F.lit("NA")).otherwise(F.col("weekly_sales").cast("string")).alias("Weekly_Sales"),
        F.when(r % DIRTY_WORD == 0, F.lit("yes")).otherwise(F.col("is_holiday").cast("string")).alias("IsHoliday"),
    )


def dirty_features_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features as a source file: text columns, dates as Feb 5, 2010, MarkDown5 absent, 'NA'
    markdowns, 'n/a' temperatures and unparseable dates on some rows."""
    f = features_frame(spark, sf_dir)
    r = F.col("store_id") * 31 + _weeks("feature_date")
    return f.select(
        F.col("store_id").cast("string").alias("Store"),
        F.when(r % DIRTY_DATE == 0, F.lit("bad")).otherwise(F.date_format("feature_date", "MMM d, yyyy")).alias("Date"),
        F.when(r % DIRTY_TEMP == 0, F.lit("n/a")).otherwise(F.col("temperature").cast("string")).alias("Temperature"),
        F.col("fuel_price").cast("string").alias("Fuel_Price"),
        F.when(r % DIRTY_NA == 0, F.lit("NA")).otherwise(F.col("markdown1").cast("string")).alias("MarkDown1"),
        F.col("markdown2").cast("string").alias("MarkDown2"),
        F.col("markdown3").cast("string").alias("MarkDown3"),
        F.col("markdown4").cast("string").alias("MarkDown4"),
        F.col("cpi").cast("string").alias("CPI"),
        F.col("unemployment").cast("string").alias("Unemployment"),
        F.col("is_holiday").cast("string").alias("IsHoliday"),
    )


# Spellings of one date: column -> datetime pattern.
SPELLED_DATES = {
    "iso": "yyyy-MM-dd", "us": "M/d/yyyy", "us_padded": "MM/dd/yyyy", "european": "dd/MM/yyyy", "dotted": "d.M.yyyy",
    "named": "MMM d, yyyy", "named_full": "MMMM d, yyyy", "dashed_name": "d-MMM-yyyy", "compact": "yyyyMMdd",
    "us_clock": "M/d/yyyy H:mm",
}


def spelled_dates_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales rows' keys and their date in ten spellings, with words and
    missing values on some rows."""
    s = sales_frame(spark, sf_dir)
    r = F.col("store_id") * 31 + F.col("dept_id") * 7 + _weeks("sales_date")
    spelled = [
        F.when((r + i) % DIRTY_DATE == 0, F.lit("bad")).when((r + i) % DIRTY_WORD == 0, F.lit("N/A"))
        .otherwise(F.date_format("sales_date", p)).alias(c)
        for i, (c, p) in enumerate(SPELLED_DATES.items())
    ]
    return s.select("store_id", "dept_id", "sales_date", *spelled)
