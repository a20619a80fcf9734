"""Governed SQL: accepted reads and rejected statements."""

import pytest

from shelfcast.operators.governed import GovernedSqlError, governed_session, governed_sql, preview
from shelfcast.plans.warehouse import Warehouse

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def iso(spark):
    w = Warehouse.from_testdata(spark, SF_SMALL)
    return governed_session(spark, {t: w.table(t) for t in ("dim_store", "fact_sales", "fact_demand", "dim_date")})


def test_accepts_reads_and_caps(iso):
    df = governed_sql(iso, "select store_id, weekly_sales from fact_sales;", row_limit=7)
    assert df.count() == 7
    df = governed_sql(iso, """with t as (select store_id, sum(weekly_sales) s from fact_sales group by store_id)
        select t.store_id, d.store_type from t join dim_store d on t.store_id = d.store_id -- trailing comment""")
    assert df.count() <= 100
    assert governed_sql(iso, "select * from dim_store where store_id in (select store_id from fact_sales)").count() > 0


def test_keeps_the_callers_limit(iso):
    many = governed_sql(iso, "select store_id from fact_sales").count()
    assert many == 100
    assert governed_sql(iso, "select store_id from fact_sales limit 150").count() == 150
    assert governed_sql(iso, "select store_id from fact_sales order by weekly_sales limit 3").count() == 3


def test_keeps_a_limit_below_the_top(iso):
    assert governed_sql(iso, "select * from (select store_id from fact_sales limit 250) x order by 1").count() == 250
    assert governed_sql(iso, "with t as (select store_id from fact_sales limit 250) select * from t").count() == 250
    assert governed_sql(iso, "(select store_id from fact_sales limit 90) union all (select store_id from fact_sales limit 80)").count() == 170


@pytest.mark.parametrize("sql", [
    "select store_id, sum(weekly_sales) over (partition by store_id order by sales_date) from fact_sales",
    "select store_id, to_date('2010-01-01'), nvl(weekly_sales, 0), case when is_holiday then 1 else 2 end from fact_sales",
    "select year(sales_date) y, month(sales_date) m, round(avg(weekly_sales), 2), count(distinct dept_id) from fact_sales group by 1, 2",
    "select s.* from fact_sales s, (select max(sales_date) d from fact_sales) x where s.sales_date = x.d",
    "select s.store_id, s.weekly_sales / t.total from fact_sales s cross join (select sum(weekly_sales) total from fact_sales) t",
    "select store_id, (select max(weekly_sales) from fact_sales f where f.store_id = d.store_id) m from dim_store d",
    "select store_id from dim_store d where exists (select 1 from fact_sales f where f.store_id = d.store_id and weekly_sales > 10)",
    "select store_id, percentile_approx(weekly_sales, 0.5), stddev(weekly_sales), corr(weekly_sales, dept_id) from fact_sales group by 1",
    "select store_id, upper(store_type), concat_ws('-', store_type, cast(store_id as string)), date_trunc('month', date'2020-01-05') from dim_store",
    "select store_id, m, v from dim_store lateral view stack(2, 'a', cast(store_id as bigint), 'b', store_size) t as m, v",
    "select store_id, x from dim_store lateral view explode(array(1, 2, 3)) t as x",
    "select coalesce(store_id, -1), grouping_id() from fact_sales group by rollup(store_id)",
    "select date_add(sales_date, 7), sales_date + interval 3 days, datediff(sales_date, date'2012-01-01') from fact_sales",
])
def test_accepts(iso, sql):
    governed_sql(iso, sql).collect()


@pytest.mark.parametrize("sql", [
    "select count(*) from fact_sales a join fact_sales b on 1=1",
    "select count(*) from fact_sales a join fact_sales b on a.store_id <> b.dept_id or true",
    "select count(*) from fact_sales a join fact_sales b on a.store_id < b.store_id",
    "select count(*) from fact_sales a left join fact_sales b on a.weekly_sales > 3",
    "select count(*) from fact_sales, lateral explode(sequence(1, 1000000))",
    "select count(*) from fact_sales a, lateral (select b.store_id from fact_sales b)",
    "select count(*) from fact_sales a, lateral (select b.store_id from fact_sales b where b.store_id > a.store_id)",
    "select count(*) from fact_sales lateral view explode(split(repeat('a,', 100000), ',')) t as x",
    "select count(*) from fact_sales lateral view explode(split(cast(store_id as string), '')) t as x",
    "select sequence(1, 1000000000) from dim_store",
    "select * from dim_store join range(100000000) r on r.id % 5 = store_id",
    "select count(*) from fact_sales where store_id not in (select store_id + dept_id from fact_sales) or exists (select 1 from fact_sales b where b.dept_id > 3 and b.store_id > fact_sales.store_id)",
    "select input_file_name(), current_user(), uuid() from dim_store",
    "select to_date(java_method('java.lang.System', 'getenv', 'HOME')) from dim_store",
    "select transform(array(1), x -> x) from dim_store",
])
def test_rejects_joins_generators_and_functions(iso, sql):
    with pytest.raises(GovernedSqlError):
        governed_sql(iso, sql)


@pytest.mark.parametrize("sql", [
    "drop table fact_sales",
    "delete from fact_sales",
    "insert into fact_sales select * from fact_sales",
    "select 1; select 2",
    "select * from raw.sales",
    "select * from marts.fact_sales",
    "select * from fact_sales) union all (select * from raw.sales",
    "select * from parquet.`/root/testdata/sf0.001/nation.parquet`",
    "select source_file from fact_sales",
    "select * from fact_sales where store_id in (select store from raw.sales)",
    "select * from identifier('raw.sales')",
    "select * from global_temp.no_such_view",
    "select 1",
    "",
    "select reflect('java.lang.System', 'getProperty', 'user.home') from dim_store",
    "select java_method('java.lang.System', 'getenv', 'HOME') from dim_store",
    "select * from dim_store where try_reflect('java.lang.System', 'lineSeparator') is null",
    "select count(*) from fact_sales s cross join fact_sales t",
    "select count(*) from fact_sales s, fact_sales t",
])
def test_rejects(iso, spark, sql):
    spark.sql("create database if not exists raw")
    if not spark.catalog.tableExists("raw.sales"):
        spark.range(3).selectExpr("cast(id as int) store").write.saveAsTable("raw.sales")
    with pytest.raises(GovernedSqlError):
        governed_sql(iso, sql)


def test_temp_views_stay_isolated(iso, spark):
    assert "fact_sales" not in [t.name for t in spark.catalog.listTables() if t.isTemporary]


def test_preview(iso):
    rows = preview(governed_sql(iso, "select store_id, weekly_sales / 3 x, sales_date from fact_sales"), 12).collect()
    assert len(rows) == 12
    assert all(isinstance(r["sales_date"], str) and r["x"] == round(r["x"], 4) for r in rows)
