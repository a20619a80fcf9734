"""DuckDB oracle SQL for every oracle-checkable query.

Each query is the same computation written in ANSI SQL over the test
tables: the adapter CTEs, then the layer CTEs the query needs, then the
query.  Conventions that make two engines agree bit for bit:

* money is summed as DECIMAL(18,4), then cast to double;
* averages are that sum over the non-NULL count;
* ``round`` of a double is written as a decimal round of its shortest text
  (``sround``), which is how Spark rounds doubles;
* date parts are cast to int (DuckDB returns BIGINT).
"""

from __future__ import annotations

from ..functions.scalar import RISK_ACTIONS

TS = "timestamp '2024-01-01 00:00:00'"


def sround(expr: str, scale: int) -> str:
    return (
        f"(case when {expr} is null or isinf({expr}) or isnan({expr}) then {expr} "
        f"else cast(round(cast(cast({expr} as varchar) as decimal(38,10)), {scale}) as double) end)"
    )


def msum(expr: str) -> str:
    return f"cast(sum(cast({expr} as decimal(18,4))) as double)"


def mavg(expr: str) -> str:
    return f"({msum(expr)} / nullif(cast(count({expr}) as double), 0))"


def mstd(expr: str) -> str:
    x = f"cast(cast(round({expr} * 10000.0) as bigint) as decimal(38,0))"
    n, total = f"cast(nullif(count({expr}), 0) as decimal(38,0))", f"sum({x})"
    q = f"cast(cast({total} as hugeint) // cast({n} as hugeint) as decimal(38,0))"
    r = f"({total} - {q} * {n})"
    around = f"(sum({x} * {x}) - {q} * {total} - {q} * {r})"
    spread = f"(cast({around} as double) - cast({r} * {r} as double) / cast({n} as double))"
    return f"(sqrt(greatest({spread}, 0.0) / cast({n} as double)) / 10000.0)"


def wape_sql(a: str = "actual_demand", p: str = "predicted_demand") -> str:
    num = f"cast(sum(abs(cast({a} as decimal(18,4)) - cast({p} as decimal(18,4)))) as double)"
    den = f"cast(sum(abs(cast({a} as decimal(18,4)))) as double)"
    return f"({num} / nullif({den}, 0))"


def score_sql(p: str, inv: str) -> str:
    return f"(case when {inv} <= 0 then cast('Infinity' as double) else {p} / {inv} end)"


def category_sql(s: str) -> str:
    return (
        f"(case when {s} is null or isnan({s}) or isinf({s}) then 'Critical' when {s} < 0.60 then 'Low' "
        f"when {s} <= 0.90 then 'Medium' when {s} <= 1.10 then 'High' else 'Critical' end)"
    )


def action_sql(cat: str) -> str:
    whens = " ".join(f"when {cat} = '{k}' then '{v}'" for k, v in RISK_ACTIONS.items())
    return f"(case {whens} end)"


def rank_sql(cat: str) -> str:
    return f"(case {cat} when 'Critical' then 1 when 'High' then 2 when 'Medium' then 3 else 4 end)"


def severity_sql(z: str, t: float = 2.0) -> str:
    return f"(case when abs({z}) >= 3 then 'High' when abs({z}) >= {t} then 'Medium' else 'Low' end)"


def direction_sql(z: str) -> str:
    return f"(case when {z} > 0 then 'Sales spike' else 'Sales drop' end)"


# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "a_sales": ("""
select s_nationkey store_id, p_size % 10 + 1 dept_id, cast(date_trunc('week', l_shipdate) as date) sales_date,
  cast(sum(cast(l_extendedprice as decimal(12,2)) * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)))) as double) weekly_sales,
  weekofyear(cast(date_trunc('week', l_shipdate) as date)) in (6, 36, 47, 52) is_holiday
from lineitem join supplier on l_suppkey = s_suppkey join part on l_partkey = p_partkey
group by s_nationkey, p_size % 10 + 1, date_trunc('week', l_shipdate)""", ()),
    "a_stores": ("""
select n_nationkey store_id, chr(65 + n_regionkey % 3) store_type, 100000 + n_nationkey * 4000 store_size from nation""", ()),
    "a_features": ("""
select c_nationkey store_id, cast(date_trunc('week', o_orderdate) as date) feature_date,
  cast(20 + 10 * count(case when o_orderstatus = 'O' then 1 end) as double) temperature,
  2e0 + count(*) / 4e0 fuel_price,
  1e2 * count(case when o_orderpriority like '1%' then 1 end) markdown1,
  1e2 * count(case when o_orderpriority like '2%' then 1 end) markdown2,
  1e2 * count(case when o_orderpriority like '3%' then 1 end) markdown3,
  1e2 * count(case when o_orderpriority like '4%' then 1 end) markdown4,
  1e2 * count(case when o_orderpriority like '5%' then 1 end) markdown5,
  cast(200 + month(cast(date_trunc('week', o_orderdate) as date)) as double) cpi,
  cast(case when c_nationkey % 6 <> 0 then 5 + c_nationkey % 4 end as double) unemployment,
  weekofyear(cast(date_trunc('week', o_orderdate) as date)) in (6, 36, 47, 52) is_holiday
from orders join customer on o_custkey = c_custkey
group by c_nationkey, date_trunc('week', o_orderdate)""", ()),
    "a_inventory": ("""
with w as (select *, cast(cast(sales_date - date '1995-01-02' as int) / 7 as int) wk from a_sales)
select store_id, dept_id, sales_date inventory_date, concat('SKU-', store_id, '-', dept_id) sku,
  case when (store_id * 5 + dept_id * 3 + wk) % 97 = 0 then 0e0
       else cast(cast(weekly_sales as decimal(16,4)) * cast(35 + (store_id * 31 + dept_id * 17 + wk * 13) % 171 as decimal(4,0)) as double) / 1e2
  end available_inventory,
  weekly_sales * 0.25e0 safety_stock_units, weekly_sales * 0.6e0 reorder_point_units
from w where (store_id * 7 + dept_id * 11 + wk) % 23 <> 0""", ("a_sales",)),
    "raw_sales": (f"""
select store_id store, dept_id dept, sales_date date, weekly_sales, is_holiday,
  'a_sales' source_file, {TS} loaded_at from a_sales""", ("a_sales",)),
    "raw_stores": (f"""
select store_id store, store_type, cast(store_size as bigint) size, 'a_stores' source_file, {TS} loaded_at
from a_stores""", ("a_stores",)),
    "raw_features": (f"""
select store_id store, feature_date date, temperature, fuel_price, markdown1, markdown2, markdown3, markdown4,
  markdown5, cpi, unemployment, is_holiday, 'a_features' source_file, {TS} loaded_at from a_features""", ("a_features",)),
    "raw_inventory": (f"""
select store_id store, dept_id dept, inventory_date date, sku, available_inventory, safety_stock_units,
  reorder_point_units, 'a_inventory' source_file, {TS} loaded_at from a_inventory""", ("a_inventory",)),
    "stg_sales": ("""
select cast(store as int) store_id, cast(dept as int) dept_id, cast(date as date) sales_date,
  cast(weekly_sales as double) weekly_sales, cast(is_holiday as boolean) is_holiday, source_file, loaded_at
from raw_sales""", ("raw_sales",)),
    "stg_stores": ("""
select cast(store as int) store_id, cast(store_type as varchar) store_type, cast(size as bigint) store_size,
  source_file, loaded_at from raw_stores""", ("raw_stores",)),
    "stg_features": ("""
select cast(store as int) store_id, cast(date as date) feature_date, cast(temperature as double) temperature,
  cast(fuel_price as double) fuel_price, cast(markdown1 as double) markdown1, cast(markdown2 as double) markdown2,
  cast(markdown3 as double) markdown3, cast(markdown4 as double) markdown4, cast(markdown5 as double) markdown5,
  cast(cpi as double) cpi, cast(unemployment as double) unemployment, cast(is_holiday as boolean) is_holiday,
  source_file, loaded_at from raw_features""", ("raw_features",)),
    "stg_inventory": ("""
select cast(store as int) store_id, cast(dept as int) dept_id, cast(date as date) inventory_date,
  cast(sku as varchar) sku, cast(available_inventory as double) available_inventory,
  cast(safety_stock_units as double) safety_stock_units, cast(reorder_point_units as double) reorder_point_units,
  source_file, loaded_at from raw_inventory""", ("raw_inventory",)),
    "fact_sales": ("""
select store_id, dept_id, sales_date, weekly_sales, is_holiday, source_file, loaded_at from stg_sales""", ("stg_sales",)),
    "fact_inventory": ("""
select store_id, dept_id, inventory_date, sku, available_inventory, safety_stock_units, reorder_point_units,
  source_file, loaded_at from stg_inventory""", ("stg_inventory",)),
    "fact_demand": ("""
select s.store_id, s.dept_id, s.sales_date demand_date, s.weekly_sales observed_demand, i.available_inventory,
  i.safety_stock_units, i.reorder_point_units
from stg_sales s left join stg_inventory i
  on s.store_id = i.store_id and s.dept_id = i.dept_id and s.sales_date = i.inventory_date""",
                    ("stg_sales", "stg_inventory")),
    "dim_store": ("""
select distinct store_id, store_type, store_size from stg_stores""", ("stg_stores",)),
    "dim_date": ("""
select date_day, cast(year(date_day) as int) as "year", cast(quarter(date_day) as int) as "quarter",
  cast(month(date_day) as int) as "month", cast(weekofyear(date_day) as int) as week_of_year,
  cast(dayofweek(date_day) as int) as day_of_week
from (select sales_date date_day from stg_sales union select feature_date from stg_features
      union select inventory_date from stg_inventory) d
where date_day is not null""", ("stg_sales", "stg_features", "stg_inventory")),
    "int_sales_features": ("""
select s.store_id, s.dept_id, s.sales_date, s.weekly_sales, s.is_holiday, st.store_type, st.store_size,
  f.temperature, f.fuel_price, f.markdown1, f.markdown2, f.markdown3, f.markdown4, f.markdown5, f.cpi,
  f.unemployment
from stg_sales s left join stg_stores st on s.store_id = st.store_id
left join stg_features f on s.store_id = f.store_id and s.sales_date = f.feature_date""",
                           ("stg_sales", "stg_stores", "stg_features")),
    "baseline": (f"""
select store_id, dept_id, sales_date, weekly_sales, baseline_forecast,
  weekly_sales - baseline_forecast forecast_error, abs(weekly_sales - baseline_forecast) absolute_error
from (select store_id, dept_id, sales_date, weekly_sales,
  coalesce(lag(weekly_sales) over (partition by store_id, dept_id order by sales_date, weekly_sales),
           cast(sum(cast(weekly_sales as decimal(18,4))) over (partition by store_id, dept_id) as double)
             / nullif(cast(count(weekly_sales) over (partition by store_id, dept_id) as double), 0)) baseline_forecast
  from fact_sales) b""", ("fact_sales",)),
    "lag_fc": (f"""
select store, dept, forecast_date, horizon_days, predicted_demand, actual_demand,
  greatest(predicted_demand * 0.85, 0.0) prediction_interval_lower, predicted_demand * 1.15 prediction_interval_upper,
  'phase_1_5_naive_baseline' model_name, 'phase_1_5' model_version, {TS} trained_at, {TS} created_at
from (
  select store_id store, dept_id dept, sales_date forecast_date, 0 horizon_days, baseline_forecast predicted_demand,
    weekly_sales actual_demand from baseline
  union all
  select store_id, dept_id, cast(sales_date + 7 as date), 7, weekly_sales, cast(null as double)
  from (select store_id, dept_id, sales_date, weekly_sales, row_number() over (partition by store_id, dept_id
        order by sales_date desc, weekly_sales desc nulls last) rn from fact_sales) l where rn = 1
) u""", ("baseline", "fact_sales")),
    "fact_forecast": ("""
select cast(store as int) store_id, cast(dept as int) dept_id, cast(forecast_date as date) forecast_date,
  cast(horizon_days as int) horizon_days, cast(predicted_demand as double) predicted_demand,
  cast(actual_demand as double) actual_demand, cast(prediction_interval_lower as double) prediction_interval_lower,
  cast(prediction_interval_upper as double) prediction_interval_upper, model_name, model_version,
  trained_at, created_at
from lag_fc""", ("lag_fc",)),
    "ml_stockout": (f"""
select cast(f.store as int) store, cast(f.dept as int) dept, f.forecast_date risk_date,
  {sround('f.predicted_demand', 2)} predicted_demand,
  {sround('i.available_inventory', 2)} available_inventory,
  {sround(score_sql('f.predicted_demand', 'i.available_inventory'), 4)} + 0e0 stockout_risk_score,
  {category_sql(score_sql('f.predicted_demand', 'i.available_inventory'))} risk_category,
  {action_sql(category_sql(score_sql('f.predicted_demand', 'i.available_inventory')))} recommended_action,
  f.model_version, f.created_at
from lag_fc f join stg_inventory i
  on f.store = i.store_id and f.dept = i.dept_id and f.forecast_date = i.inventory_date
where f.horizon_days = 0""", ("lag_fc", "stg_inventory")),
    "fact_stockout_risk": ("""
select store store_id, dept dept_id, risk_date, predicted_demand, available_inventory, stockout_risk_score,
  risk_category, recommended_action, model_version, created_at from ml_stockout""", ("ml_stockout",)),
    "ml_anomalies": (f"""
select store, dept, sales_date, {sround('weekly_sales', 2)} weekly_sales, {sround('z', 4)} + 0e0 anomaly_score,
  coalesce(abs(z) >= 2.0, false) is_anomaly, {severity_sql('z')} severity, {direction_sql('z')} direction,
  'zscore_baseline_v1' model_version, {TS} created_at
from (select s.store_id store, s.dept_id dept, s.sales_date, s.weekly_sales,
  case when g.sd is null or g.sd = 0 or g.mn = g.mx then 0.0 else (s.weekly_sales - g.mean) / g.sd end z
  from stg_sales s left join (select store_id, dept_id, {mavg('weekly_sales')} mean, {mstd('weekly_sales')} sd,
      min(weekly_sales) mn, max(weekly_sales) mx from stg_sales group by store_id, dept_id) g
    on s.store_id is not distinct from g.store_id and s.dept_id is not distinct from g.dept_id) z""",
                     ("stg_sales",)),
    "fact_anomalies": ("""
select store store_id, dept dept_id, sales_date, weekly_sales, anomaly_score, is_anomaly, severity, direction,
  model_version, created_at from ml_anomalies""", ("ml_anomalies",)),
    "demand_scored": (f"""
select store_id, dept_id, demand_date, observed_demand, available_inventory, safety_stock_units, reorder_point_units,
  {score_sql('observed_demand', 'available_inventory')} stockout_risk_score,
  {category_sql(score_sql('observed_demand', 'available_inventory'))} risk_category,
  {action_sql(category_sql(score_sql('observed_demand', 'available_inventory')))} recommended_action
from fact_demand""", ("fact_demand",)),
    "candidates": (f"""
select store_id, dept_id, sales_date, weekly_sales, z anomaly_score, coalesce(abs(z) >= 2.0, false) is_anomaly,
  {severity_sql('z')} severity, {direction_sql('z')} direction
from (select s.store_id, s.dept_id, s.sales_date, s.weekly_sales,
  case when g.sd is null or g.sd = 0 or g.mn = g.mx then 0.0 else (s.weekly_sales - g.mean) / g.sd end z
  from fact_sales s, (select {mavg('weekly_sales')} mean, {mstd('weekly_sales')} sd, min(weekly_sales) mn,
    max(weekly_sales) mx from fact_sales) g) z""", ("fact_sales",)),
}


def with_ctes(body: str, *needs: str) -> str:
    """``with`` clause holding ``needs`` and their dependencies, then ``body``."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    parts = ",\n".join(f"{n} as ({CTES[n][0]}\n)" for n in order)
    return f"with {parts}\n{body}"


CTES["tf"] = ("""
select s.date, s.weekly_sales, s.store, s.dept, f.temperature, f.fuel_price, f.markdown1, f.markdown2, f.markdown3,
  f.markdown4, f.markdown5, f.cpi, f.unemployment,
  coalesce(lower(trim(coalesce(cast(s.is_holiday as varchar), cast(f.is_holiday as varchar)))) in ('true', '1', 'yes'),
           false) is_holiday,
  st.store_type, st.size, cast(year(s.date) as int) as "year", cast(month(s.date) as int) as "month",
  cast(weekofyear(s.date) as int) as week_of_year, cast(dayofyear(s.date) as int) as day_of_year
from raw_sales s left join raw_features f on s.store = f.store and s.date = f.date
left join raw_stores st on s.store = st.store
where s.store is not null and s.dept is not null and s.date is not null and s.weekly_sales is not null""",
              ("raw_sales", "raw_features", "raw_stores"))


CTES["dirty_sales"] = ("""
select cast(store_id as varchar) "Store", cast(dept_id as varchar) "Dept",
  case when r % 17 = 0 then 'bad' else strftime(sales_date, '%-m/%-d/%Y') end "Date",
  case when r % 13 = 0 then 'NA' else cast(weekly_sales as varchar) end "Weekly_Sales",
  case when r % 19 = 0 then 'yes' else cast(is_holiday as varchar) end "IsHoliday"
from (select *, store_id * 31 + dept_id * 7 + cast(cast(sales_date - date '1995-01-02' as int) / 7 as int) r
      from a_sales) s""", ("a_sales",))
CTES["dirty_features"] = ("""
select cast(store_id as varchar) "Store", case when r % 17 = 0 then 'bad' else strftime(feature_date, '%b %-d, %Y') end "Date",
  case when r % 11 = 0 then 'n/a' else cast(temperature as varchar) end "Temperature",
  cast(fuel_price as varchar) "Fuel_Price",
  case when r % 13 = 0 then 'NA' else cast(markdown1 as varchar) end "MarkDown1",
  cast(markdown2 as varchar) "MarkDown2", cast(markdown3 as varchar) "MarkDown3", cast(markdown4 as varchar) "MarkDown4",
  cast(cpi as varchar) "CPI", cast(unemployment as varchar) "Unemployment", cast(is_holiday as varchar) "IsHoliday"
from (select *, store_id * 31 + cast(cast(feature_date - date '1995-01-02' as int) / 7 as int) r from a_features) f""",
                          ("a_features",))

# Spelled dates as the source file has them: column -> strftime format.
SPELLED = {
    "iso": "%Y-%m-%d", "us": "%-m/%-d/%Y", "us_padded": "%m/%d/%Y", "european": "%d/%m/%Y", "dotted": "%-d.%-m.%Y",
    "named": "%b %-d, %Y", "named_full": "%B %-d, %Y", "dashed_name": "%-d-%b-%Y", "compact": "%Y%m%d",
    "us_clock": "%-m/%-d/%Y %-H:%M",
}
_SPELLED_TEXT = ", ".join(
    f"case when (r + {i}) % 17 = 0 then 'bad' when (r + {i}) % 19 = 0 then 'N/A' else strftime(sales_date, '{f}') end {c}"
    for i, (c, f) in enumerate(SPELLED.items())
)
CTES["spelled_dates"] = (f"""
select store_id, dept_id, sales_date, {_SPELLED_TEXT}
from (select *, store_id * 31 + dept_id * 7 + cast(cast(sales_date - date '1995-01-02' as int) / 7 as int) r
      from a_sales) s""", ("a_sales",))


def int_sql(x: str) -> str:
    return f"try_cast(round(try_cast({x} as double)) as int)"
