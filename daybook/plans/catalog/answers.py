"""Small answers of the reports: best and worst, fitted lines, removed rows, last evaluations, run-log documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import diagnostics, eda, panel, runs
from daybook.plans.catalog.aggregates import _ACF, _E, _PPF
from daybook.plans.catalog.base import KEYS, PANEL, PREDICTED, ctes, i, plain, query, r, s
from daybook.plans.catalog.tables import _LAST, _LOG, _log, fresh_warehouse, per_store_metrics
from daybook.sources import retail


def _panel(spark, sf_dir):
    return retail.sales_panel(spark, sf_dir, "nation")


@query("best_weekday", ctes(PANEL) + f"""
select {i('"DayOfWeek"')} as best_weekday from panel group by "DayOfWeek" order by avg("Sales") desc, "DayOfWeek" limit 1""")
def best_weekday(spark, sf_dir):
    return plain(eda.best_weekday(_panel(spark, sf_dir)))


@query("best_month", ctes(PANEL) + f"""
select {i('month("Date")')} as best_month, {r('avg("Sales")')} as mean from panel group by month("Date")
order by avg("Sales") desc, month("Date") limit 1""")
def best_month(spark, sf_dir):
    return plain(eda.best_month(_panel(spark, sf_dir)))


@query("store_extremes", ctes(PANEL, 'means as (select "Store", avg("Sales") as m from panel group by "Store")') + f"""
select {i('(select "Store" from means order by m desc, "Store" limit 1)')} as best_store,
       {i('(select "Store" from means order by m, "Store" limit 1)')} as worst_store, {r("max(m) / min(m)", 6)} as ratio from means""")
def store_extremes(spark, sf_dir):
    return plain(eda.store_extremes(_panel(spark, sf_dir)), 6)


@query("qq_fit", ctes(*PREDICTED, f"""ranked as (select {_E} as v, row_number() over (order by {_E}) as k, cast(count(*) over () as double) as n from pred),
points as (select v, k, case when k = n then pow(0.5, 1 / n) when k = 1 then 1 - pow(0.5, 1 / n) else (k - 0.3175) / (n + 0.365) end as p from ranked),
parts as (select *, p - 0.5 as q, 0.180625 - (p - 0.5) * (p - 0.5) as u, sqrt(-ln(least(p, 1 - p))) as t from points),
line as (select {_PPF} as x, v as y from parts)""") + f"""
select {r("regr_slope(y, x)")} as slope, {r("regr_intercept(y, x)")} as intercept, {r("corr(x, y)", 6)} as r from line""")
def qq_fit(spark, sf_dir):
    return plain(diagnostics.qq_fit(diagnostics.qq_normal(retail.predictions(spark, sf_dir))), special={"r": 6})


@query("residual_acf_pooled", ctes(*PREDICTED, _ACF) + f"""
select {i("lag")} as lag, {r("sum(p) / (select sum(p0) from sizes)", 6)} as acf, {r("(select 1.96 / sqrt(sum(n)) from sizes)", 6)} as band,
       {i("(select count(*) from sizes)")} as stores_used from acfs group by lag""")
def residual_acf_pooled(spark, sf_dir):
    return plain(diagnostics.residual_acf_pooled(retail.predictions(spark, sf_dir)), 6)


@query("full_calendar_per_store", ctes(PANEL) + f"""
select {i('c."Store"')} as "Store", {s('c."Date"')} as "Date", {r('p."Sales"')} as "Sales"
from (select "Store", cast(unnest(generate_series(min("Date"), max("Date"), interval 1 day)) as date) as "Date" from panel group by "Store") c
left join panel p on c."Store" = p."Store" and c."Date" = p."Date\"""")
def full_calendar_per_store(spark, sf_dir):
    return plain(panel.full_calendar(_panel(spark, sf_dir).select("Store", "Date", "Sales"), per_store=True))


@query("delete_history", ctes(PANEL) + f"""
select {i("count(*) filter (\"Date\" < date '1995-03-15')")} as removed, {i("count(*) filter (\"Date\" >= date '1995-03-15')")} as left_rows,
       {s("min(\"Date\") filter (\"Date\" >= date '1995-03-15')")} as first_day from panel""")
def delete_history(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "delete_history")
    warehouse.upsert_history(_panel(spark, sf_dir))
    removed = warehouse.delete_history_before("1995-03-15")
    left = warehouse.load_history().agg(F.count(F.lit(1)).alias("left_rows"), F.min("Date").alias("first_day"))
    return plain(left.withColumn("removed", F.lit(removed)))


@query("history_between", ctes(PANEL) + f"""
select {KEYS}, {r('"Sales"')} as "Sales" from panel where "Date" between date '1996-02-20' and date '1997-05-03'""")
def history_between(spark, sf_dir):
    """Only the months of the asked days are opened."""
    warehouse = fresh_warehouse(spark, "history_between")
    warehouse.upsert_history(_panel(spark, sf_dir))
    return plain(warehouse.load_history("1996-02-20", "1997-05-03").select("Store", "Date", "Sales"))


@query("recent_metrics", ctes(*PREDICTED, """trained as (select "Store", date '2024-01-01' + cast("Store" as int) as d, avg(abs("ActualSales" - "PredictedSales")) as mae from pred group by "Store")""") + f"""
select 'v_' || "Store" as model_version, {s("d")} as trained_on, {r("mae")} as mae from trained order by d desc limit 20""")
def recent_metrics(spark, sf_dir):
    """The last 20 evaluations, as the trend display reads them."""
    warehouse = fresh_warehouse(spark, "recent_metrics")
    store = F.substring("model_version", 3, 20).cast("int")
    dated = per_store_metrics(spark, sf_dir).withColumn("trained_at", F.date_add(F.lit("2024-01-01").cast("date"), store).cast("timestamp"))
    warehouse.append_metrics(dated)
    last = runs.recent_records(warehouse.model_metrics(), "trained_at")
    return plain(last.select("model_version", F.to_date("trained_at").alias("trained_on"), "mae"))


@query("run_log_json", ctes(_LOG, _LAST.format(50)) + f"""
select dag_name || '_' || strftime(started_at, '%Y-%m-%d %H:%M:%S') as run_id, dag_name, status, {r("duration")} as duration_seconds,
       strftime(started_at, '%Y-%m-%d %H:%M:%S') as started_at from last_runs""")
def run_log_json(spark, sf_dir):
    """The retained runs as one JSON document, and back."""
    kept = runs.last_n_runs(_log(spark, sf_dir)).withColumn("error_message", F.lit(None).cast("string"))
    back = runs.parse_run_log(runs.run_log_document(kept))
    return plain(back.select(
        "run_id", "dag_name", "status", "duration_seconds", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at")
    ))
