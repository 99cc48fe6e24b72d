"""Joins, set operations and membership."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import calendar
from daybook.operators import eda, evaluation, joins, panel
from daybook.plans.catalog.base import (
    KEYS, MERGED, PANEL, PRED, STORE_DIM, ctes, forecast, i, lag_sql, plain, query, r, s,
)
from daybook.plans.catalog.windows import _REQUESTS, lag_requests
from daybook.sources import retail


@query("join_store_dim", ctes(PANEL, STORE_DIM, MERGED) + f"""
select {KEYS}, {r('"Sales"')} as "Sales", "StoreType", "Assortment", {r('"CompetitionDistance"')} as "CompetitionDistance",
       {i('"Promo2"')} as "Promo2", "PromoInterval" from merged""")
def join_store_dim(spark, sf_dir):
    df = joins.join_store_dim(retail.sales_panel(spark, sf_dir, "nation"), retail.store_dim(spark, sf_dir))
    return plain(df.select("Store", "Date", "Sales", "StoreType", "Assortment", "CompetitionDistance", "Promo2", "PromoInterval"))


@query("unmatched_stores", f"""
select distinct {i("l_suppkey")} as "Store" from lineitem where l_suppkey not in (select n_nationkey from nation)""")
def unmatched_stores(spark, sf_dir):
    sales = retail.table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("Store"))
    return plain(joins.unmatched_stores(sales, retail.store_dim(spark, sf_dir)))


@query("asof_last_promo", ctes(PANEL, 'promo as (select "Store", "Date" as "LastPromoDate" from panel where "Promo" = 1)') + f"""
select {i('n."Store"')} as "Store", {s('n."Date"')} as "Date", {s('p."LastPromoDate"')} as "LastPromoDate"
from (select * from panel where "Promo" <> 1) n asof left join promo p
  on n."Store" = p."Store" and n."Date" >= p."LastPromoDate\"""")
def asof_last_promo(spark, sf_dir):
    df = joins.asof_last_promo(retail.sales_panel(spark, sf_dir, "nation"))
    return plain(df.select("Store", "Date", "LastPromoDate"))


@query("join_lags_back", ctes(PANEL, _REQUESTS, f'lagged as (select "Store", "Date", {", ".join(lag_sql((7,)))} from panel)') + f"""
select {i('q."Store"')} as "Store", {s('q."Date"')} as "Date", {r('l."SalesLag_7"')} as "SalesLag_7", {r('l."RollingMean_7"')} as "RollingMean_7"
from requests q left join lagged l on q."Store" = l."Store" and q."Date" = l."Date\"""")
def join_lags_back(spark, sf_dir):
    lags = panel.raw_lags(retail.sales_panel(spark, sf_dir, "nation"), (7,)).select("Store", "Date", "SalesLag_7", "RollingMean_7")
    return plain(panel.join_lags_back(lag_requests(spark, sf_dir), lags))


@query("full_calendar", ctes(PANEL) + f"""
select {i('c."Store"')} as "Store", {s('c."Date"')} as "Date", {r('p."Sales"')} as "Sales"
from (select "Store", cast(unnest(generate_series((select min("Date") from panel), (select max("Date") from panel), interval 1 day)) as date) as "Date"
      from (select distinct "Store" from panel)) c
left join panel p on c."Store" = p."Store" and c."Date" = p."Date\"""")
def full_calendar(spark, sf_dir):
    days = panel.full_calendar(retail.sales_panel(spark, sf_dir, "nation").select("Store", "Date", "Sales"))
    return plain(days)


PRED_B = forecast("pred_b", 28)


@query("compare_runs", ctes(PANEL, PRED, PRED_B) + f"""
select {i('a."Store"')} as "Store", {s('a."Date"')} as "Date", {r('a."ActualSales"')} as "ActualSales",
       {r('a."PredictedSales"')} as "PredictedSales_v1", {r('b."PredictedSales"')} as "PredictedSales_v2",
       {r('b."PredictedSales" - a."PredictedSales"')} as "PredictionDelta",
       {r('case when a."PredictedSales" > 0 then (b."PredictedSales" - a."PredictedSales") / a."PredictedSales" * 100 else 0 end')} as "DeltaPct"
from pred a join pred_b b on a."Store" = b."Store" and a."Date" = b."Date\"""")
def compare_runs(spark, sf_dir):
    return plain(evaluation.compare_runs(retail.predictions(spark, sf_dir, 7), retail.predictions(spark, sf_dir, 28)))


@query("attach_group_metric", ctes(PANEL, STORE_DIM) + f"""
select {i('d."Store"')} as "Store", "StoreType", {r('coalesce(m, 0)')} as "PromoSales"
from store_dim d left join (select "Store", avg("Sales") as m from panel where "Promo" = 1 and "StateHoliday" <> '0' group by 1) p
  on d."Store" = p."Store\"""")
def attach_group_metric(spark, sf_dir):
    sales = retail.sales_panel(spark, sf_dir, "nation").where((F.col("Promo") == 1) & (F.col("StateHoliday") != "0"))
    metric = sales.groupBy("Store").agg(F.avg("Sales").alias("PromoSales"))
    stores = retail.store_dim(spark, sf_dir).select("Store", "StoreType")
    return plain(evaluation.attach_group_metric(stores, metric, "Store", "PromoSales"))


_CASE = eda.BusinessCase()
_REVENUE = f"{_CASE.target_stores * _CASE.working_days} * avg(\"Sales\")"


@query("scenario_grid", ctes(PANEL, f'base as (select {_REVENUE} as revenue from panel where "Sales" > 0)', f"""
cells as (select b, m, revenue * {_CASE.loss_rate!r} * (b - m) / 100 * {_CASE.realization} as saving from base,
  (select unnest([15.0, 20.0, 25.0, 30.0, 35.0]) as b), (select unnest([6.0, 8.0, 10.0, 12.0, 15.0]) as m))""") + f"""
select {r("b")} as baseline_error, {r("m")} as model_error, {r("saving", 2)} as annual_saving,
       {r(f"case when saving * 100 - {_CASE.yearly_cost!r} > 0 then {_CASE.development_cost!r} / (saving * 100 - {_CASE.yearly_cost!r}) * 12 else 99 end")}
         as payback_months from cells""")
def scenario_grid(spark, sf_dir):
    grid = eda.scenario_grid(retail.sales_panel(spark, sf_dir, "nation"))
    return plain(grid.select("baseline_error", "model_error", "annual_saving", "payback_months"), special={"annual_saving": 2})


_WEEK = """(cast(extract(isoyear from {d}) as int) * 100 + weekofyear({d}))"""


@query("period_membership", ctes(PANEL, f"""periods as (
  select distinct {_WEEK.format(d="cast(o_orderdate as date)")} as k from orders where o_totalprice > 450000)""") + f"""
select {KEYS}, {r('"Sales"')} as "Sales" from panel where {_WEEK.format(d='"Date"')} in (select k from periods)""")
def period_membership(spark, sf_dir):
    day = F.to_date("o_orderdate")
    periods = (
        retail.table(spark, sf_dir, "orders").where("o_totalprice > 450000")
        .select(calendar.week_key(calendar.iso_year(day), F.weekofyear(day)).alias("WeekKey")).distinct()
    )
    key = calendar.week_key(calendar.iso_year(F.col("Date")), F.weekofyear("Date"))
    df = joins.period_membership(retail.sales_panel(spark, sf_dir, "nation"), periods, key)
    return plain(df.select("Store", "Date", "Sales"))


@query("concat", ctes(PANEL, PRED) + f"""
select {KEYS}, {r('"Sales"')} as "Sales", cast(null as double) as "PredictedSales" from panel
union all select {KEYS}, cast(null as double), {r('"PredictedSales"')} from pred""")
def concat(spark, sf_dir):
    left = retail.sales_panel(spark, sf_dir, "nation").select("Store", "Date", "Sales")
    right = retail.predictions(spark, sf_dir).select("Store", "Date", "PredictedSales")
    return plain(joins.concat(left, right))


@query("canonical_sort", ctes(PANEL) + f"""select {KEYS}, {r('"Sales"')} as "Sales" from panel order by "panel"."Store", "panel"."Date\"""")
def canonical_sort(spark, sf_dir):
    return plain(joins.canonical_sort(retail.sales_panel(spark, sf_dir, "nation").select("Store", "Date", "Sales")))
