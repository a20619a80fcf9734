"""Named queries over the test tables, with their DuckDB oracle SQL.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame computed from the
test tables in ``sf_dir``; ``ORACLE[name]`` is the same computation as one
SQL text.  Every query runs over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import forecast_reads as fr
from ..operators import kpis, scoring
from ..operators import quality as _quality
from . import oracle as _o
from .oracle import mavg, msum, rank_sql, with_ctes, wape_sql
from .warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
BUILDERS: dict[str, Callable[[Warehouse], DataFrame]] = {}  # name -> warehouse -> DataFrame


def register(name: str, sql: str | None = None, *needs: str):
    def deco(fn: Callable[[Warehouse], DataFrame]) -> Callable[[Warehouse], DataFrame]:
        BUILDERS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: fn(Warehouse.shared(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_ctes(sql, *needs)
        return fn

    return deco


def _table_query(name: str) -> None:
    register(name, f"select * from {name}", name)(lambda w: w.table(name))


# -- staging and marts ------------------------------------------------------
for _t in ("stg_sales", "stg_stores", "stg_features", "stg_inventory", "int_sales_features", "dim_store",
           "dim_date", "fact_sales", "fact_inventory", "fact_demand"):
    _table_query(_t)


# -- sales KPIs -------------------------------------------------------------
@register("executive_metrics", f"""
select coalesce({msum('s.weekly_sales')}, 0.0) total_sales, count(*) sales_records,
  count(distinct s.store_id) store_count, count(distinct s.dept_id) dept_count,
  min(s.sales_date) start_date, max(s.sales_date) end_date,
  cast(count_if(d.available_inventory is not null
    and d.observed_demand / nullif(d.available_inventory, 0) > 0.90) as bigint) high_or_critical_risk_count
from fact_sales s left join fact_demand d
  on s.store_id = d.store_id and s.dept_id = d.dept_id and s.sales_date = d.demand_date""", "fact_sales", "fact_demand")
def _executive_metrics(w: Warehouse) -> DataFrame:
    return kpis.executive_metrics(w.fact_sales, w.fact_demand)


_TREND = f"""select sales_date, {msum('weekly_sales')} weekly_sales, count(distinct store_id) store_count,
  count(distinct dept_id) dept_count from fact_sales group by sales_date"""


@register("sales_trend", _TREND + " order by sales_date", "fact_sales")
def _sales_trend(w: Warehouse) -> DataFrame:
    return kpis.sales_trend(w.fact_sales)


@register("recent_trend", _TREND + " order by sales_date desc limit 20", "fact_sales")
def _recent_trend(w: Warehouse) -> DataFrame:
    return kpis.recent_trend(w.fact_sales)


_STORES = f"""select s.store_id, ds.store_type, ds.store_size, {msum('s.weekly_sales')} total_sales,
  {mavg('s.weekly_sales')} avg_weekly_sales, count(*) sales_records
from fact_sales s left join dim_store ds on s.store_id = ds.store_id
group by s.store_id, ds.store_type, ds.store_size order by total_sales desc nulls last, s.store_id"""
_DEPTS = f"""select dept_id, {msum('weekly_sales')} total_sales, {mavg('weekly_sales')} avg_weekly_sales,
  count(*) sales_records from fact_sales group by dept_id order by total_sales desc nulls last, dept_id"""


@register("store_sales", _STORES, "fact_sales", "dim_store")
def _store_sales(w: Warehouse) -> DataFrame:
    return kpis.store_sales(w.fact_sales, w.dim_store)


@register("top_stores", _STORES + " limit 10", "fact_sales", "dim_store")
def _top_stores(w: Warehouse) -> DataFrame:
    return kpis.top_stores(w.fact_sales, w.dim_store)


@register("department_sales", _DEPTS, "fact_sales")
def _department_sales(w: Warehouse) -> DataFrame:
    return kpis.department_sales(w.fact_sales)


@register("top_departments", _DEPTS + " limit 10", "fact_sales")
def _top_departments(w: Warehouse) -> DataFrame:
    return kpis.top_departments(w.fact_sales)


@register("sales_totals", f"""
select {msum('weekly_sales')} total_sales, count(*) sales_records, count(distinct store_id) store_count,
  count(distinct dept_id) dept_count, min(sales_date) start_date, max(sales_date) end_date from fact_sales""",
          "fact_sales")
def _sales_totals(w: Warehouse) -> DataFrame:
    return kpis.sales_totals(w.fact_sales)


# -- lag-1 baseline and forecast reads ---------------------------------------
@register("baseline_forecast", "select * from baseline", "baseline")
def _baseline(w: Warehouse) -> DataFrame:
    return fr.baseline_forecast(w.fact_sales)


_BDEN = "coalesce(cast(sum(abs(cast(weekly_sales as decimal(18,4)))) as double), 0.0)"
_BNUM = "coalesce(cast(sum(cast(absolute_error as decimal(18,4))) as double), 0.0)"


@register("baseline_metrics", f"""
select coalesce({msum('baseline_forecast')}, 0.0) predicted_demand, coalesce({msum('weekly_sales')}, 0.0) actual_demand,
  case when {_BDEN} = 0 then 0.0 else {_BNUM} / {_BDEN} end wape, count(*) forecast_rows, count(*) scored_rows,
  min(sales_date) start_date, max(sales_date) end_date from baseline""", "baseline")
def _baseline_metrics(w: Warehouse) -> DataFrame:
    return fr.baseline_metrics(w.fact_sales)


@register("baseline_trend", f"""
select forecast_date, actual_demand, predicted_demand, forecast_rows,
  abs(actual_demand - predicted_demand) absolute_error,
  abs(actual_demand - predicted_demand) / nullif(abs(actual_demand), 0) wape
from (select sales_date forecast_date, coalesce({msum('weekly_sales')}, 0.0) actual_demand,
  coalesce({msum('baseline_forecast')}, 0.0) predicted_demand, count(*) forecast_rows
  from baseline group by sales_date) g order by forecast_date""", "baseline")
def _baseline_trend(w: Warehouse) -> DataFrame:
    return fr.baseline_trend(w.fact_sales)


@register("forecast_results", """
select store_id, dept_id, forecast_date, horizon_days, predicted_demand, actual_demand, prediction_interval_lower,
  prediction_interval_upper, model_name, model_version, actual_demand - predicted_demand forecast_error,
  abs(actual_demand - predicted_demand) absolute_error
from fact_forecast order by forecast_date, store_id, dept_id""", "fact_forecast")
def _forecast_results(w: Warehouse) -> DataFrame:
    return fr.forecast_results(w.fact_forecast, w.fact_sales)


@register("forecast_metrics", f"""
select coalesce({msum('predicted_demand')}, 0.0) predicted_demand, coalesce({msum('actual_demand')}, 0.0) actual_demand,
  {wape_sql()} wape, count(*) forecast_rows, cast(count_if(actual_demand is not null) as bigint) scored_rows,
  min(forecast_date) start_date, max(forecast_date) end_date
from fact_forecast where horizon_days = 0""", "fact_forecast")
def _forecast_metrics(w: Warehouse) -> DataFrame:
    return fr.forecast_metrics(w.fact_forecast, w.fact_sales)


_FTREND = f"""select forecast_date, {msum('predicted_demand')} predicted_demand, {msum('actual_demand')} actual_demand,
  {wape_sql()} wape, count(*) forecast_rows from fact_forecast where horizon_days = 0 group by forecast_date"""


@register("forecast_trend", _FTREND + " order by forecast_date", "fact_forecast")
def _forecast_trend(w: Warehouse) -> DataFrame:
    return fr.forecast_trend(w.fact_forecast, w.fact_sales)


@register("forecast_long", f"""
select forecast_date, 'actual_demand' series, actual_demand demand from ({_FTREND}) t where actual_demand is not null
union all
select forecast_date, 'predicted_demand' series, predicted_demand demand from ({_FTREND}) t
where predicted_demand is not null""",
          "fact_forecast")
def _forecast_long(w: Warehouse) -> DataFrame:
    return fr.forecast_long(fr.forecast_trend(w.fact_forecast, w.fact_sales))


@register("forecast_detail", """
select forecast_date, store_id, dept_id, horizon_days, actual_demand, predicted_demand, prediction_interval_lower,
  prediction_interval_upper, actual_demand - predicted_demand forecast_error,
  abs(actual_demand - predicted_demand) absolute_error, model_version
from fact_forecast where horizon_days = 0
order by forecast_date desc, absolute_error desc nulls last, store_id, dept_id limit 250""", "fact_forecast")
def _forecast_detail(w: Warehouse) -> DataFrame:
    return fr.forecast_detail(w.fact_forecast, w.fact_sales)


@register("forecast_filter_options", """
select distinct store_id, dept_id, horizon_days from fact_forecast order by store_id, dept_id, horizon_days""",
          "fact_forecast")
def _filter_options(w: Warehouse) -> DataFrame:
    return fr.forecast_filter_options(w.fact_forecast, w.fact_sales)


@register("accuracy_by_version", f"""
select model_version, count(*) forecast_rows, {msum('predicted_demand')} predicted_demand,
  {msum('actual_demand')} actual_demand, {wape_sql()} wape
from fact_forecast group by model_version order by forecast_rows desc, model_version""", "fact_forecast")
def _accuracy(w: Warehouse) -> DataFrame:
    return fr.accuracy_by_version(w.fact_forecast)


# -- stockout ---------------------------------------------------------------
@register("demand_detail", "select * from demand_scored order by demand_date, store_id, dept_id", "demand_scored")
def _demand_detail(w: Warehouse) -> DataFrame:
    return scoring.demand_detail(w.fact_demand)


@register("stockout_risk", "select * from ml_stockout", "ml_stockout")
def _stockout_risk(w: Warehouse) -> DataFrame:
    return w.ml["stockout_risk"]


@register("stockout_queue", f"""
select store_id, dept_id, risk_date, predicted_demand, available_inventory, stockout_risk_score, risk_category,
  recommended_action, model_version from fact_stockout_risk
order by {rank_sql('risk_category')}, stockout_risk_score desc nulls first, risk_date, store_id, dept_id""",
          "fact_stockout_risk")
def _stockout_queue(w: Warehouse) -> DataFrame:
    return scoring.stockout_queue(w.fact_stockout_risk, w.fact_demand)


@register("top_stockout", """
select store_id, dept_id, risk_date, predicted_demand, available_inventory, stockout_risk_score, risk_category,
  recommended_action from fact_stockout_risk
order by stockout_risk_score desc nulls first, risk_date, store_id, dept_id limit 10""", "fact_stockout_risk")
def _top_stockout(w: Warehouse) -> DataFrame:
    return scoring.top_stockout(w.fact_stockout_risk)


@register("risk_summary", f"""
select risk_category, count(*) risk_rows,
  case when max(stockout_risk_score) = cast('Infinity' as double) then cast('Infinity' as double)
       else {mavg("case when stockout_risk_score <> cast('Infinity' as double) then stockout_risk_score end")} end
    avg_risk_score,
  max(stockout_risk_score) max_risk_score
from fact_stockout_risk group by risk_category order by {rank_sql('risk_category')}, risk_category""",
          "fact_stockout_risk")
def _risk_summary(w: Warehouse) -> DataFrame:
    return scoring.risk_summary(w.fact_stockout_risk)


@register("risk_distribution", """
select c.risk_category, coalesce(n, 0) risk_count
from (values ('Critical', 0), ('High', 1), ('Medium', 2), ('Low', 3)) c(risk_category, risk_order)
left join (select risk_category, count(*) n from fact_stockout_risk group by risk_category) k
  on c.risk_category = k.risk_category order by risk_order""", "fact_stockout_risk")
def _risk_distribution(w: Warehouse) -> DataFrame:
    return scoring.risk_distribution(scoring.stockout_queue(w.fact_stockout_risk, w.fact_demand))


# -- anomalies --------------------------------------------------------------
@register("sales_anomalies", "select * from ml_anomalies", "ml_anomalies")
def _sales_anomalies(w: Warehouse) -> DataFrame:
    return w.ml["sales_anomalies"]


@register("anomaly_candidates", """
select * from candidates order by is_anomaly desc, anomaly_score desc nulls last, sales_date, store_id, dept_id""",
          "candidates")
def _anomaly_candidates(w: Warehouse) -> DataFrame:
    return scoring.anomaly_candidates(w.fact_sales)


_QUEUE = """select store_id, dept_id, sales_date, weekly_sales, anomaly_score, is_anomaly, severity, direction,
  model_version from fact_anomalies"""


@register("anomaly_queue", _QUEUE + " order by is_anomaly desc, abs(anomaly_score) desc nulls last, sales_date, "
          "store_id, dept_id", "fact_anomalies")
def _anomaly_queue(w: Warehouse) -> DataFrame:
    return scoring.anomaly_queue(w.fact_anomalies, w.fact_sales)


@register("anomaly_summary", f"""
select severity, direction, count(*) anomaly_rows, {mavg('abs(anomaly_score)')} avg_abs_anomaly_score
from fact_anomalies where is_anomaly group by severity, direction
order by anomaly_rows desc, severity, direction""", "fact_anomalies")
def _anomaly_summary(w: Warehouse) -> DataFrame:
    return scoring.anomaly_summary(w.fact_anomalies)


@register("anomaly_kpis", """
select count(*) candidate_rows, cast(count_if(is_anomaly) as bigint) flagged_rows, max(abs(anomaly_score)) max_abs_score
from fact_anomalies""", "fact_anomalies")
def _anomaly_kpis(w: Warehouse) -> DataFrame:
    return scoring.anomaly_kpis(scoring.anomaly_queue(w.fact_anomalies, w.fact_sales))


# -- model frames -----------------------------------------------------------
def _tf(w: Warehouse) -> DataFrame:
    from ..operators import features

    return features.training_frame(w.raw["sales"], w.raw["stores"], w.raw["features"])


@register("training_frame", "select * from tf", "tf")
def _training_frame(w: Warehouse) -> DataFrame:
    return _tf(w)


@register("next_week_rows", """
select cast(date + 7 as date) date, weekly_sales, store, dept, temperature, fuel_price, markdown1, markdown2,
  markdown3, markdown4, markdown5, cpi, unemployment, is_holiday, store_type, size,
  cast(year(date + 7) as int) as "year", cast(month(date + 7) as int) as "month",
  cast(weekofyear(date + 7) as int) as week_of_year, cast(dayofyear(date + 7) as int) as day_of_year
from (select *, row_number() over (partition by store, dept order by date desc, weekly_sales desc nulls last) rn
      from tf) l where rn = 1""", "tf")
def _next_week_rows(w: Warehouse) -> DataFrame:
    from ..operators import features

    return features.next_week_from(w.raw["sales"], w.raw["stores"], w.raw["features"])


@register("time_split_rows", f"""
select side, count(*) n_rows, min(date) first_date, max(date) last_date,
  cast(sum(store * 1000 + dept) as bigint) key_sum, {msum('weekly_sales')} total_sales
from (select *, case when row_number() over (order by date, store, dept, weekly_sales)
        <= (select least(greatest(1, cast(floor(count(*) * 0.8) as bigint)), count(*) - 1) from tf)
        then 'train' else 'test' end side from tf) s group by side""", "tf")
def _time_split_rows(w: Warehouse) -> DataFrame:
    from ..operators import features

    return features.split_report(_tf(w))


@register("time_split_sizes", """
select cast(max(case when small then n else k end) as bigint) training_rows,
  min(case when small or rn <= k then date end) train_start, max(case when small or rn <= k then date end) train_end,
  cast(max(case when small then n else n - k end) as bigint) validation_rows,
  min(case when small or rn > k then date end) validation_start,
  max(case when small or rn > k then date end) validation_end
from (select date, row_number() over (order by date, store, dept, weekly_sales) rn from tf) r,
  (select n, n < 10 small, least(greatest(1, cast(floor(n * 0.8) as bigint)), n - 1) k
   from (select count(*) n from tf) c) k""", "tf")
def _time_split_sizes(w: Warehouse) -> DataFrame:
    from ..operators import features

    return features.split_summary(_tf(w))


_NUMERIC = ("store", "dept", "temperature", "fuel_price", "markdown1", "markdown2", "markdown3", "markdown4", "markdown5", "cpi",
            "unemployment", "is_holiday", "size", "year", "month", "week_of_year", "day_of_year")


@register("feature_medians", " union all ".join(
    f"select '{c}' column_name, count({c}) n, cast(median(cast({c} as double)) as double) median from tf" for c in _NUMERIC), "tf")
def _feature_medians(w: Warehouse) -> DataFrame:
    from ..operators.features import NUMERIC
    from ..operators.selection import median_report

    from ..session import cut_lineage

    values = _tf(w).select(*[F.col(c).cast("double").alias(c) for c in NUMERIC])
    return median_report(cut_lineage(values), NUMERIC)


@register("raw_measure_medians", " union all ".join(
    f"select '{c}' column_name, count({c}) n, median({c}) median from {t}" for t, c in (
        ("raw_features", "temperature"), ("raw_sales", "weekly_sales"), ("raw_inventory", "available_inventory"))),
          "raw_features", "raw_sales", "raw_inventory")
def _raw_measure_medians(w: Warehouse) -> DataFrame:
    from ..operators.selection import median_report

    parts = [median_report(w.raw[t], [c]) for t, c in (
        ("features", "temperature"), ("sales", "weekly_sales"), ("inventory", "available_inventory"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register("forest_samples", """
select cast(tree as int) tree, n training_rows, cast(round_even(0.65 * n, 0) as bigint) sampled_rows
from (select least(greatest(1, cast(floor(count(*) * 0.8) as bigint)), count(*) - 1) n from tf) t, range(50) r(tree)""", "tf")
def _forest_samples(w: Warehouse) -> DataFrame:
    from ..operators import forest

    return forest.sample_report(_tf(w))


def _trained(w: Warehouse):
    """The forest trained once per warehouse on the chronological 80 %."""
    from ..operators import forest

    if getattr(w, "_trained", None) is None:
        w._trained = forest.train(_tf(w))
    return w._trained


@register("forest_forecast")
def _forest_forecast(w: Warehouse) -> DataFrame:
    """Score every observed row and the next week with the trained forest (rows check)."""
    from ..operators import forest

    return forest.forecast_output(_tf(w), _trained(w))


@register("holdout_metrics")
def _holdout_metrics(w: Warehouse) -> DataFrame:
    from ..operators import forest

    return forest.metrics_frame(_trained(w))


# -- prepare and synthetic sources ------------------------------------------
@register("prepared_sales", f"""
select {_o.int_sql('"Store"')} "Store", {_o.int_sql('"Dept"')} "Dept", cast(try_strptime("Date", '%m/%d/%Y') as date) "Date",
  try_cast("Weekly_Sales" as double) "Weekly_Sales", "IsHoliday" from dirty_sales""", "dirty_sales")
def _prepared_sales(w: Warehouse) -> DataFrame:
    from ..operators.prepare import prepare_sales
    from ..sources.adapter import dirty_sales_source

    return prepare_sales(dirty_sales_source(w.spark, w.sf_dir))


@register("prepared_features", f"""
select {_o.int_sql('"Store"')} "Store", cast(try_strptime("Date", '%b %d, %Y') as date) "Date", try_cast("Temperature" as double) "Temperature",
  try_cast("Fuel_Price" as double) "Fuel_Price", coalesce(try_cast("MarkDown1" as double), 0.0) "MarkDown1",
  coalesce(try_cast("MarkDown2" as double), 0.0) "MarkDown2", coalesce(try_cast("MarkDown3" as double), 0.0) "MarkDown3",
  coalesce(try_cast("MarkDown4" as double), 0.0) "MarkDown4", 0.0 "MarkDown5", try_cast("CPI" as double) "CPI",
  try_cast("Unemployment" as double) "Unemployment", "IsHoliday" from dirty_features""", "dirty_features")
def _prepared_features(w: Warehouse) -> DataFrame:
    from ..operators.prepare import prepare_features
    from ..sources.adapter import dirty_features_source

    return prepare_features(dirty_features_source(w.spark, w.sf_dir))


def _loaded_twice(w: Warehouse) -> tuple[str, str]:
    """Sales landed as three files and loaded by the ledger: two files, then all
    three with a failure in the last, then all three, then all three again."""
    import uuid

    from ..contracts import RAW_CONTRACTS
    from ..session import checkpoint_dir
    from ..sources import ledger
    from ..sources.files import contract_read, write_csv

    if getattr(w, "_ledger_table", None) is None:
        contract = RAW_CONTRACTS["sales"]
        landing = f"{checkpoint_dir(w.spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
        paths = [f"{landing}/sales_{i}.csv" for i in range(3)]
        for i, path in enumerate(paths):
            write_csv(w.raw["sales"].where(F.col("store") % 3 == i).select(*contract.names), path)
        name = f"sales_{uuid.uuid4().hex}"

        def read(path: str) -> DataFrame:
            return contract_read(w.spark, path, contract)

        def torn(path: str) -> DataFrame:
            if path != paths[2]:
                return read(path)
            stop = F.when(F.col("store") >= 0, F.raise_error(F.lit("the source broke off"))).cast("double")
            return read(path).withColumn("weekly_sales", stop)

        def load(files: list[str], reader) -> None:
            ledger.load_files(w.spark, "raw_ledger", name, contract.table_schema, files, reader)

        load(paths[:2], read)
        try:
            load(paths, torn)
        except Exception as error:  # the planned failure, and no other
            if "the source broke off" not in str(error):
                raise
        load(paths, read)
        load(paths, read)
        w._ledger_table = ("raw_ledger", name)
    return w._ledger_table


@register("repeatable_load", "select store, dept, date, weekly_sales, is_holiday from raw_sales", "raw_sales")
def _repeatable_load(w: Warehouse) -> DataFrame:
    db, name = _loaded_twice(w)
    return w.spark.table(f"{db}.{name}").select("store", "dept", "date", "weekly_sales", "is_holiday")


@register("load_ledger", """select 'sales_' || (store % 3) || '.csv' file_name, count(*) row_count
from raw_sales group by store % 3""", "raw_sales")
def _load_ledger(w: Warehouse) -> DataFrame:
    from ..sources import ledger

    return ledger.ledger(w.spark, *_loaded_twice(w)).select("file_name", "row_count")


def _landed_torn(w: Warehouse) -> tuple[str, str]:
    """The sales as a landed CSV of raw lines, some cut short, read into the
    contract: (folder of the rows read, folder of the rows set aside)."""
    import uuid

    from ..contracts import RAW_CONTRACTS
    from ..session import checkpoint_dir
    from ..sources.files import contract_read

    if getattr(w, "_torn", None) is None:
        base = f"{checkpoint_dir(w.spark).rstrip('/')}/torn-{uuid.uuid4().hex}"
        contract = RAW_CONTRACTS["sales"]
        cells = [F.col(c).cast("string") for c in contract.names]
        short = (F.col("store") * 31 + F.col("dept") * 7 + F.dayofyear("date")) % 29 == 0
        lines = w.raw["sales"].select(F.when(short, F.concat_ws(",", *cells[:3])).otherwise(F.concat_ws(",", *cells)))
        # One column of whole lines, named by the header line; no character of theirs separates or quotes.
        raw_lines = lines.toDF(",".join(contract.names)).write.option("header", True).option("sep", "\u0001")
        raw_lines.csv(f"{base}/sales.csv")
        read = contract_read(w.spark, f"{base}/sales.csv", contract, quarantine=f"{base}/aside")
        read.write.parquet(f"{base}/read")
        w._torn = (f"{base}/read", f"{base}/aside")
    return w._torn


@register("staged_files", "select store, dept, date, weekly_sales, is_holiday from raw_sales", "raw_sales")
def _staged_files(w: Warehouse) -> DataFrame:
    """The sales' landing file, staged twice byte for byte, and read from there."""
    import uuid

    from ..contracts import RAW_CONTRACTS
    from ..session import checkpoint_dir
    from ..sources.files import contract_read, write_csv
    from ..sources.staging import stage_files

    if getattr(w, "_staged", None) is None:
        base, contract = f"{checkpoint_dir(w.spark).rstrip('/')}/staging-{uuid.uuid4().hex}", RAW_CONTRACTS["sales"]
        write_csv(w.raw["sales"].select(*contract.names), f"{base}/landing/sales.csv")
        copied = [stage_files(w.spark, [f"{base}/landing/sales.csv"], f"{base}/bucket/raw") for _ in range(2)]
        if copied != [["sales.csv"], []]:
            raise RuntimeError(f"staging isn't repeatable: {copied}")
        w._staged = f"{base}/bucket/raw/sales.csv"
    return contract_read(w.spark, w._staged, RAW_CONTRACTS["sales"]).select(*RAW_CONTRACTS["sales"].names)


_SHORT = "(store * 31 + dept * 7 + dayofyear(date)) % 29 = 0"


@register("landed_rows", f"select store, dept, date, weekly_sales, is_holiday from raw_sales where not ({_SHORT})", "raw_sales")
def _landed_rows(w: Warehouse) -> DataFrame:
    return w.spark.read.parquet(_landed_torn(w)[0]).select("store", "dept", "date", "weekly_sales", "is_holiday")


@register("quarantined_rows", f"""select store || ',' || dept || ',' || strftime(date, '%Y-%m-%d') record,
  '3 fields instead of 5' reason from raw_sales where {_SHORT}""", "raw_sales")
def _quarantined_rows(w: Warehouse) -> DataFrame:
    return w.spark.read.parquet(_landed_torn(w)[1]).select("record", "reason")


_READ_SPELLED = {c: f"cast(try_strptime({c}, '{f.replace('%-', '%')}') as date)" for c, f in _o.SPELLED.items()}


@register("date_spellings", "select store_id, dept_id, sales_date, "
          + ", ".join(f"{v} {c}" for c, v in _READ_SPELLED.items()) + " from spelled_dates", "spelled_dates")
def _date_spellings(w: Warehouse) -> DataFrame:
    from ..sources.adapter import SPELLED_DATES, spelled_dates_source
    from ..sources.dates import parse_date, spellings

    source = spelled_dates_source(w.spark, w.sf_dir)
    chosen = spellings(source, SPELLED_DATES)
    return source.select("store_id", "dept_id", "sales_date", *[parse_date(F.col(c), s).alias(c) for c, s in chosen.items()])


_SPELLING_OF = {
    "iso": "iso", "us": "month/day/year", "us_padded": "month/day/year", "european": "day/month/year",
    "dotted": "day.month.year", "named": "mon day, year", "named_full": "month day, year",
    "dashed_name": "day-mon-year", "compact": "yearmonthday", "us_clock": "month/day/year",
}


@register("date_votes", " union all ".join(
    f"""select '{c}' column_name, '{_SPELLING_OF[c]}' spelling, count(*) filter ({c} <> 'N/A') n_filled,
  count({v}) n_parsed, count(*) filter ({c} = 'bad') n_rejected from spelled_dates""" for c, v in _READ_SPELLED.items()),
          "spelled_dates")
def _date_votes(w: Warehouse) -> DataFrame:
    from ..sources.adapter import SPELLED_DATES, spelled_dates_source
    from ..sources.dates import vote_report

    return vote_report(spelled_dates_source(w.spark, w.sf_dir), SPELLED_DATES)


@register("synthetic_inventory")
def _synthetic_inventory(w: Warehouse) -> DataFrame:
    from ..operators.synth import synthetic_inventory

    return synthetic_inventory(w.raw["sales"])


@register("synthetic_weather")
def _synthetic_weather(w: Warehouse) -> DataFrame:
    from ..operators.synth import synthetic_weather

    return synthetic_weather(w.raw["features"])


# -- data quality and pipeline health ---------------------------------------
def _q():
    from ..operators import quality

    return quality


_CTE_OF = {  # layer.table -> oracle CTE holding it
    "raw.sales": "raw_sales", "raw.stores": "raw_stores", "raw.features": "raw_features",
    "raw.inventory": "raw_inventory", "ml.demand_forecasts": "lag_fc", "ml.stockout_risk": "ml_stockout",
    "ml.sales_anomalies": "ml_anomalies", "staging.stg_sales": "stg_sales", "staging.stg_stores": "stg_stores",
    "staging.stg_features": "stg_features", "staging.stg_inventory": "stg_inventory",
    "staging.int_sales_features": "int_sales_features", **{f"marts.{t}": t for t in (
        "dim_store", "dim_date", "fact_sales", "fact_inventory", "fact_demand", "fact_forecast", "fact_stockout_risk",
        "fact_anomalies")},
}


def _nn_sql() -> tuple[str, list[str]]:
    q = _q()
    parts = [
        f"select '{t}' check_table, '{c}' check_column, count_if({c} is null) failing_rows from {_CTE_OF[t]}"
        for t, cols in q.NOT_NULL.items() for c in cols
    ]
    body = " union all ".join(parts)
    return (f"select check_table, check_column, cast(failing_rows as bigint) failing_rows, "
            f"case when failing_rows = 0 then 'pass' else 'fail' end status from ({body}) u",
            sorted({_CTE_OF[t] for t in q.NOT_NULL}))


def _uq_sql() -> tuple[str, list[str]]:
    q = _q()
    parts = [
        f"select '{t}' check_table, '{c}' check_column, count(*) failing_rows from (select {c} from {_CTE_OF[t]} "
        f"where {c} is not null group by {c} having count(*) > 1) d"
        for t, c in q.UNIQUE
    ]
    return (f"select check_table, check_column, cast(failing_rows as bigint) failing_rows, "
            f"case when failing_rows = 0 then 'pass' else 'fail' end status from ({' union all '.join(parts)}) u",
            sorted({_CTE_OF[t] for t, _ in q.UNIQUE}))


def _rel_sql() -> tuple[str, list[str]]:
    q = _q()
    parts = [
        f"select '{ct}' check_table, '{cc}' check_column, '{pt}.{pc}' parent_key, count(*) failing_rows "
        f"from {_CTE_OF[ct]} c where c.{cc} is not null and not exists "
        f"(select 1 from {_CTE_OF[pt]} p where p.{pc} = c.{cc})"
        for ct, cc, pt, pc in q.RELATIONSHIPS
    ]
    needs = sorted({_CTE_OF[x] for r in q.RELATIONSHIPS for x in (r[0], r[2])})
    return (f"select check_table, check_column, parent_key, cast(failing_rows as bigint) failing_rows, "
            f"case when failing_rows = 0 then 'pass' else 'fail' end status from ({' union all '.join(parts)}) u",
            needs)


def _rc_sql() -> tuple[str, list[str]]:
    q = _q()
    parts = [f"select '{n.upper()}' object_name, count(*) row_count from {_CTE_OF[n]}" for n in q.ROW_COUNT_OBJECTS]
    return " union all ".join(parts), sorted({_CTE_OF[n] for n in q.ROW_COUNT_OBJECTS})


def _inv_sql() -> tuple[str, list[str]]:
    from ..plans.warehouse import Warehouse as _W

    parts = []
    for name, cte in {**_CTE_OF, "raw.weather": "a_features"}.items():
        db, t = name.split(".")
        if name in _W.VIEWS:
            parts.append(f"select '{db.upper()}' table_schema, '{t.upper()}' table_name, 'VIEW' table_type, "
                         f"cast(0 as bigint) row_count, cast(null as timestamp) created, cast(null as timestamp) last_altered")
        else:
            parts.append(f"select '{db.upper()}' table_schema, '{t.upper()}' table_name, 'BASE TABLE' table_type, "
                         f"count(*) row_count, {_o.TS} created, {_o.TS} last_altered from {cte}")
    return " union all ".join(parts), sorted(set(_CTE_OF.values()) | {"a_features"})


_NN, _UQ, _REL, _RC, _INV = _nn_sql(), _uq_sql(), _rel_sql(), _rc_sql(), _inv_sql()


@register("not_null_report", _NN[0], *_NN[1])
def _not_null_report(w: Warehouse) -> DataFrame:
    return _q().not_null_report(w.layer_tables())


@register("unique_report", _UQ[0], *_UQ[1])
def _unique_report(w: Warehouse) -> DataFrame:
    return _q().unique_report(w.layer_tables())


@register("relationship_report", _REL[0], *_REL[1])
def _relationship_report(w: Warehouse) -> DataFrame:
    return _q().relationship_report(w.layer_tables())


@register("row_count_report", _RC[0], *_RC[1])
def _row_count_report(w: Warehouse) -> DataFrame:
    return _q().row_count_report(w.layer_tables())


def _inventory(w: Warehouse) -> DataFrame:
    return w.inventory()


_EXPECTED = "select * from (values " + ", ".join(
    f"('{s}', '{t}', '{g}', '{d}', {_quality.STAGE_ORDER[g]})" for s, t, g, d in _quality.EXPECTED_OBJECTS
) + ") e(table_schema, table_name, pipeline_stage, description, stage_order)"
_HEALTH = f"""select e.pipeline_stage, e.table_schema, e.table_name, e.table_schema || '.' || e.table_name object_name,
  e.description, coalesce(i.table_type, 'MISSING') object_type, cast(coalesce(i.row_count, 0) as bigint) row_count,
  i.created, i.last_altered,
  case when i.table_name is null then 'Missing'
       when i.table_type = 'BASE TABLE' and coalesce(i.row_count, 0) = 0 then 'Empty' else 'Ready' end status,
  e.stage_order
from ({_EXPECTED}) e left join ({_INV[0]}) i on e.table_schema = i.table_schema and e.table_name = i.table_name"""


@register("platform_summary", f"select * from ({_INV[0]}) i order by table_schema, table_name", *_INV[1])
def _platform_summary(w: Warehouse) -> DataFrame:
    return _q().platform_summary(_inventory(w))


@register("pipeline_health", f"""select pipeline_stage, table_schema, table_name, object_name, description, object_type,
  row_count, created, last_altered, status from ({_HEALTH}) h order by stage_order, table_schema, table_name""",
          *_INV[1])
def _pipeline_health(w: Warehouse) -> DataFrame:
    return _q().pipeline_health(_inventory(w))


_QUALITY = f"""select table_schema || '.' || table_name object_name, table_type, row_count,
  case when table_type = 'BASE TABLE' and row_count > 0 then 'Pass' when table_type = 'VIEW' then 'Pass'
       else 'Review' end status, last_altered
from ({_INV[0]}) i where table_schema in ('RAW', 'MARTS', 'ML')"""


@register("quality_status", _QUALITY, *_INV[1])
def _quality_status(w: Warehouse) -> DataFrame:
    return _q().quality_status(_inventory(w))


@register("layer_summary", f"""
select pipeline_stage, cast(count(object_name) as bigint) total_objects,
  cast(count_if(status = 'Ready') as bigint) ready_objects, cast(count_if(status <> 'Ready') as bigint) review_objects,
  cast(sum(row_count) as bigint) row_count, max(last_altered) last_altered,
  case when count_if(status <> 'Ready') = 0 then 'Ready' else cast(count_if(status <> 'Ready') as varchar) || ' to review'
  end stage_status
from ({_HEALTH}) h group by pipeline_stage order by min(stage_order)""", *_INV[1])
def _layer_summary(w: Warehouse) -> DataFrame:
    q = _q()
    return q.layer_summary(q.pipeline_health(_inventory(w)))


_STAGES = ", ".join(f"('{k}', {v})" for k, v in _quality.STAGE_ORDER.items())


@register("stage_statuses", f"""
select s.stage pipeline_stage, s.stage_order, case when count(h.object_name) = 0 then 'Not found'
  when count_if(h.status <> 'Ready') = 0 then 'Ready' else cast(count_if(h.status <> 'Ready') as varchar) || ' to review' end stage_status
from (values {_STAGES}) s(stage, stage_order)
left join (select * from ({_HEALTH}) x where table_schema in ('RAW', 'MARTS')) h on h.pipeline_stage = s.stage
group by s.stage, s.stage_order""", *_INV[1])
def _stage_statuses(w: Warehouse) -> DataFrame:
    """Labels where only the raw and mart objects are looked at."""
    q = _q()
    seen = q.pipeline_health(_inventory(w)).where(F.col("table_schema").isin("RAW", "MARTS"))
    return q.stage_statuses(q.layer_summary(seen))


@register("rows_by_layer", f"""
select pipeline_stage, cast(sum(row_count) as bigint) row_count from ({_HEALTH}) h
group by pipeline_stage having sum(row_count) > 0""", *_INV[1])
def _rows_by_layer(w: Warehouse) -> DataFrame:
    q = _q()
    return q.rows_by_layer(q.layer_summary(q.pipeline_health(_inventory(w))))


@register("pipeline_kpis", f"""
select max(last_altered) latest_refresh, cast(count_if(status = 'Ready') as bigint) ready_objects,
  cast(count_if(status <> 'Ready') as bigint) review_objects, count(*) expected_objects,
  cast(count_if(object_type = 'BASE TABLE') as bigint) base_tables, cast(coalesce(sum(row_count), 0) as bigint) warehouse_rows
from ({_HEALTH}) h""", *_INV[1])
def _pipeline_kpis(w: Warehouse) -> DataFrame:
    q = _q()
    return q.pipeline_kpis(q.pipeline_health(_inventory(w)))


@register("loaded_table_counts", f"""
select count(distinct case when table_schema = 'RAW' then table_name end) raw_objects,
  count(distinct case when table_schema = 'MARTS' then table_name end) mart_objects,
  count(distinct case when table_schema = 'ML' then table_name end) ml_objects,
  count(distinct case when table_schema = 'RAW' and row_count > 0 then table_name end) raw_loaded,
  count(distinct case when table_schema = 'MARTS' and row_count > 0 then table_name end) mart_loaded,
  (select cast(count_if(status = 'Pass') as bigint) from ({_QUALITY}) q) checks_passing,
  (select cast(count_if(status <> 'Pass') as bigint) from ({_QUALITY}) q) open_reviews
from ({_INV[0]}) i""", *_INV[1])
def _loaded_table_counts(w: Warehouse) -> DataFrame:
    q = _q()
    inv = _inventory(w)
    return q.loaded_table_counts(inv, q.quality_status(inv))


# -- governed access --------------------------------------------------------
GOVERNED_STORE_SALES_SQL = """select s.store_id, ds.store_type, ds.store_size,
  cast(sum(cast(s.weekly_sales as decimal(18,4))) as double) as total_sales,
  cast(sum(cast(s.weekly_sales as decimal(18,4))) as double) / count(s.weekly_sales) as avg_weekly_sales,
  count(*) as sales_records
from fact_sales as s left join dim_store as ds on s.store_id = ds.store_id
group by s.store_id, ds.store_type, ds.store_size
order by total_sales desc, s.store_id"""


def _governed_session(w: Warehouse):
    """The isolated read session over this warehouse's marts, built once."""
    from ..operators.governed import governed_session

    if getattr(w, "_governed", None) is None:
        w._governed = governed_session(w.spark, {t: w.table(t) for t in (
            "dim_store", "dim_date", "fact_sales", "fact_inventory", "fact_demand", "fact_forecast",
            "fact_stockout_risk", "fact_anomalies")})
    return w._governed


@register("governed_store_sales", f"select * from ({GOVERNED_STORE_SALES_SQL}) g limit 100", "fact_sales", "dim_store")
def _governed_store_sales(w: Warehouse) -> DataFrame:
    from ..operators.governed import governed_sql

    return governed_sql(_governed_session(w), GOVERNED_STORE_SALES_SQL, row_limit=100)


GOVERNED_ROWS_SQL = """select store_id, dept_id, sales_date, weekly_sales from fact_sales
where is_holiday order by weekly_sales desc, store_id, dept_id, sales_date limit 5000"""


@register("governed_holiday_rows", GOVERNED_ROWS_SQL, "fact_sales")
def _governed_holiday_rows(w: Warehouse) -> DataFrame:
    from ..operators.governed import governed_sql

    return governed_sql(_governed_session(w), GOVERNED_ROWS_SQL)


@register("result_preview", f"""
select store_id, store_type, store_size, {_o.sround('total_sales', 4)} total_sales,
  {_o.sround('avg_weekly_sales', 4)} avg_weekly_sales, sales_records
from ({_STORES}) s limit 12""", "fact_sales", "dim_store")
def _result_preview(w: Warehouse) -> DataFrame:
    from ..operators.governed import preview

    return preview(kpis.store_sales(w.fact_sales, w.dim_store), 12)


@register("weekly_error_rows", f"select * from ({_FTREND}) t where wape is not null", "fact_forecast")
def _weekly_error_rows(w: Warehouse) -> DataFrame:
    return fr.weekly_error_rows(fr.forecast_trend(w.fact_forecast, w.fact_sales))


@register("anomaly_triage", _QUEUE + " where severity = 'High' and direction = 'Sales spike'", "fact_anomalies")
def _anomaly_triage(w: Warehouse) -> DataFrame:
    return scoring.triage(scoring.anomaly_queue(w.fact_anomalies, w.fact_sales), "High", "Sales spike")


# -- fallbacks served when the model marts are absent (A13) ------------------
_SHAPE = """select store_id, dept_id, sales_date forecast_date, 0 horizon_days, baseline_forecast predicted_demand,
  weekly_sales actual_demand, greatest(baseline_forecast * 0.85, 0.0) prediction_interval_lower,
  baseline_forecast * 1.15 prediction_interval_upper, 'phase_1_5_naive_baseline' model_name,
  'phase_1_5' model_version, forecast_error, absolute_error from baseline"""


@register("forecast_results_fallback", _SHAPE, "baseline")
def _forecast_results_fallback(w: Warehouse) -> DataFrame:
    return fr.forecast_results(None, w.fact_sales)


@register("forecast_detail_fallback", f"""
select store_id, dept_id, forecast_date, actual_demand, predicted_demand, forecast_error, absolute_error,
  horizon_days, model_version from ({_SHAPE}) s
order by absolute_error desc nulls last, forecast_date, store_id, dept_id limit 250""", "baseline")
def _forecast_detail_fallback(w: Warehouse) -> DataFrame:
    return fr.forecast_detail(None, w.fact_sales)


@register("filter_options_fallback", """
select distinct store_id, dept_id, 0 horizon_days from fact_sales order by store_id, dept_id""", "fact_sales")
def _filter_options_fallback(w: Warehouse) -> DataFrame:
    return fr.forecast_filter_options(None, w.fact_sales)


@register("stockout_queue_proxy", f"""
select store_id, dept_id, demand_date risk_date, observed_demand predicted_demand, available_inventory,
  stockout_risk_score, risk_category, recommended_action, 'observed_demand_proxy' model_version from demand_scored
order by {rank_sql('risk_category')}, stockout_risk_score desc nulls first, risk_date, store_id, dept_id""",
          "demand_scored")
def _stockout_queue_proxy(w: Warehouse) -> DataFrame:
    return scoring.stockout_queue(None, w.fact_demand)


@register("risk_distribution_proxy", """
select c.risk_category, coalesce(n, 0) risk_count
from (values ('Critical', 0), ('High', 1), ('Medium', 2), ('Low', 3)) c(risk_category, risk_order)
left join (select risk_category, count(*) n from demand_scored group by risk_category) k
  on c.risk_category = k.risk_category order by risk_order""", "demand_scored")
def _risk_distribution_proxy(w: Warehouse) -> DataFrame:
    return scoring.risk_distribution(scoring.stockout_queue(None, w.fact_demand))


from . import registry_files as _registry_files  # noqa: E402,F401 - registers its queries
