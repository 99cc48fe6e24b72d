"""Durable tables, prediction runs and the run log."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.operators import evaluation, runs
from daybook.plans.catalog.base import KEYS, PANEL, PRED, PREDICTED, ctes, i, plain, query, r, s
from daybook.plans.catalog.joins import PRED_B
from daybook.session import scratch_path
from daybook.sources import retail
from daybook.sources.tables import Warehouse, metric_rows, replace_run_log


def fresh_warehouse(spark, name):
    return Warehouse(spark, scratch_path(spark, name))


_HISTORY = f"""{KEYS}, {r('"Sales"')} as "Sales", {i('"DayOfWeek"')} as "DayOfWeek", {i('"Promo"')} as "Promo",
  "StateHoliday", {i('"SchoolHoliday"')} as "SchoolHoliday\""""


@query("scan_history", ctes(PANEL) + f"select {_HISTORY} from panel")
def scan_history(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "scan_history")
    warehouse.upsert_history(retail.sales_panel(spark, sf_dir, "nation"))
    return plain(warehouse.load_history())


@query("upsert_history", ctes(PANEL, """stored as (select * from panel where "Date" < date '1999-03-15'),
incoming as (select * replace ("Sales" + 1000 as "Sales") from panel where "Date" >= date '1999-02-10'),
merged_rows as (select * from incoming union all select * from stored anti join incoming using ("Store", "Date"))""")
       + f"select {_HISTORY} from merged_rows")
def upsert_history(spark, sf_dir):
    panel = retail.sales_panel(spark, sf_dir, "nation")
    warehouse = fresh_warehouse(spark, "upsert_history")
    warehouse.upsert_history(panel.where("Date < date '1999-03-15'"))
    warehouse.upsert_history(panel.where("Date >= date '1999-02-10'").withColumn("Sales", F.col("Sales") + 1000))
    return plain(warehouse.load_history())


@query("append_predictions", ctes(*PREDICTED) + f"""
select 'run_a' as run_id, {i('"Store"')} as store_id, {s('"Date"')} as date, {r('"PredictedSales"')} as predicted_sales,
       {r('"ActualSales"')} as actual_sales, {r('abs("ActualSales" - "PredictedSales")')} as absolute_error,
       {r('case when "ActualSales" > 0 then abs("ActualSales" - "PredictedSales") / "ActualSales" * 100 else 0 end')} as percentage_error from pred""")
def append_predictions(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "append_predictions")
    warehouse.append_predictions(evaluation.enrich_errors(retail.predictions(spark, sf_dir)), "run_a")
    return plain(warehouse.predictions().drop("created_at"))


@query("table_counts", ctes(PANEL) + f"""
select 'sales_history' as "table", {i("count(*)")} as records from panel union all select 'predictions', {i("2 * count(*)")} from panel
union all select 'pipeline_runs', {i("count(*)")} from orders union all select 'model_metrics', {i('count(distinct "Store")')} from panel""")
def table_counts(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "table_counts")
    warehouse.upsert_history(retail.sales_panel(spark, sf_dir, "nation"))
    for name, window in (("run_a", 7), ("run_b", 28)):
        warehouse.append_predictions(retail.predictions(spark, sf_dir, window), name)
    warehouse.append_runs(retail.run_log(spark, sf_dir))
    warehouse.append_metrics(per_store_metrics(spark, sf_dir))
    return plain(warehouse.table_counts())


_RUNS = f"""stored as (select 'run_a' as run_id, 1 as c, * from pred union all select 'run_b', 2, * from pred_b)"""


@query("list_runs", ctes(PANEL, PRED, PRED_B, _RUNS) + f"""
select run_id, {i("count(*)")} as records, {s('min("Date")')} as date_from, {s('max("Date")')} as date_to,
       {r('avg(abs("ActualSales" - "PredictedSales") / "ActualSales" * 100)')} as avg_mape from stored group by run_id""")
def list_runs(spark, sf_dir):
    return plain(runs.list_runs(retail.prediction_runs(spark, sf_dir)).drop("created_at"))


@query("latest_run", ctes(PANEL, PRED_B) + f"""
select 'run_b' as run_id, {i('"Store"')} as store_id, {s('"Date"')} as date, {r('"PredictedSales"')} as predicted_sales from pred_b""")
def latest_run(spark, sf_dir):
    newest = runs.latest_run(retail.prediction_runs(spark, sf_dir))
    return plain(newest.select("run_id", "store_id", "date", "predicted_sales"))


_LOG = """log as (select 'run_' || o_orderkey as run_id, o_orderpriority as dag_name,
  case when o_orderstatus = 'F' then 'failed' else 'success' end as status,
  cast(o_orderdate as timestamp) + to_seconds(o_orderkey % 86400) as started_at,
  cast(floor(o_totalprice / 1000) as double) as duration, cast(floor(o_totalprice) as bigint) as records,
  case when o_orderstatus <> 'F' then floor(o_totalprice) % 4000 / 100 end as mape from orders)"""
_LAST = "last_runs as (select * from log order by started_at desc, run_id desc limit {})"
_RUN = f"""run_id, dag_name, status, strftime(started_at, '%Y-%m-%d %H:%M:%S') as started_at, {r("duration")} as duration_seconds"""


def _log(spark, sf_dir):
    return retail.run_log(spark, sf_dir).withColumn("status", runs.normalize_status(F.col("status")))


@query("last_n_runs", ctes(_LOG, _LAST.format(50)) + f"select {_RUN} from last_runs")
def last_n_runs(spark, sf_dir):
    kept = runs.last_n_runs(_log(spark, sf_dir))
    return plain(kept.select(
        "run_id", "dag_name", "status", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), "duration_seconds"
    ))


@query("success_rate", ctes(_LOG) + f"""
select {i("count(*)")} as total_runs, {i("count(*) filter (status = 'success')")} as successful_runs,
       {r("avg(case when status = 'success' then 1.0 else 0.0 end) * 100")} as success_rate,
       strftime(max(started_at) filter (status = 'success'), '%Y-%m-%d %H:%M:%S') as last_success from log""")
def success_rate(spark, sf_dir):
    rate = runs.success_rate(_log(spark, sf_dir))
    return plain(rate.withColumn("last_success", F.date_format("last_success", "yyyy-MM-dd HH:mm:ss")))


@query("failure_streak", ctes(_LOG, """placed as (select *, max(case when status <> 'failed' then {'t': started_at, 'r': run_id} end) over () as good from log)""") + f"""
select {i("count(*) filter (good is null or {'t': started_at, 'r': run_id} > good)")} as failure_streak,
       {r("avg(case when status = 'success' then 1.0 else 0.0 end) * 100")} as success_rate,
       cast(count(*) filter (good is null or {{'t': started_at, 'r': run_id}} > good) >= 2 as bigint) as streak_alert,
       cast(avg(case when status = 'success' then 1.0 else 0.0 end) * 100 < 80 as bigint) as rate_alert from placed""")
def failure_streak(spark, sf_dir):
    return plain(runs.failure_streak(_log(spark, sf_dir)))


@query("recent_failures", ctes(_LOG, _LAST.format(10)) + f"""
select {i("count(*)")} as recent_runs, {r("avg(duration)")} as average_duration, {i("count(*) filter (status = 'failed')")} as failures,
       coalesce(string_agg(run_id, ',' order by started_at, run_id) filter (status = 'failed'), '') as failed_runs from last_runs""")
def recent_failures(spark, sf_dir):
    return plain(runs.recent_failures(_log(spark, sf_dir)))


@query("recent_records", ctes(_LOG, _LAST.format(20)) + f"""
select substring(replace(run_id, 'run_', ''), 1, 15) as id, status, strftime(started_at, '%d.%m %H:%M') as started,
       case when duration <> 0 then format('{{:.0f}}s', duration) else '-' end as duration, format('{{:,}}', records) as records,
       case when coalesce(mape, 0) <> 0 then format('{{:.2f}}%', mape) else '-' end as mape from last_runs""")
def recent_records(spark, sf_dir):
    return plain(runs.run_table(_log(spark, sf_dir)))


@query("replace_run_log", ctes(_LOG, """entries as (select * replace ('run_' || (cast(substring(run_id, 5) as bigint) % 1000) as run_id), started_at + to_seconds(cast(duration as bigint)) as finished_at from log)""") + f"""
select {_RUN} from entries qualify row_number() over (partition by run_id, dag_name order by finished_at desc, started_at desc) = 1""")
def replace_log(spark, sf_dir):
    entries = _log(spark, sf_dir).withColumns({
        "run_id": F.concat(F.lit("run_"), F.substring("run_id", 5, 20).cast("bigint") % 1000),
        "finished_at": F.col("started_at") + F.make_dt_interval(secs=F.col("duration_seconds").cast("decimal(18,6)")),
    })
    kept = replace_run_log(entries)
    return plain(kept.select(
        "run_id", "dag_name", "status", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"), "duration_seconds"
    ))


def per_store_metrics(spark, sf_dir):
    """One evaluation per store, as a training log would hold."""
    a, p = F.col("ActualSales"), F.col("PredictedSales")
    e = a - p
    return metric_rows(
        retail.predictions(spark, sf_dir).groupBy("Store").agg(
            F.avg(F.abs(e) / F.greatest(a, F.lit(1.0)) * 100).alias("MAPE"),
            F.sqrt(F.avg(e * e)).alias("RMSE"),
            F.avg(F.abs(e)).alias("MAE"),
            (1 - F.sum(e * e) / (F.var_pop(a) * F.count(F.lit(1)))).alias("R2"),
            F.count(F.lit(1)).alias("n_test_samples"),
        ).withColumns({
            "model_version": F.concat(F.lit("v_"), F.col("Store")),
            "trained_at": F.lit("2024-01-01").cast("timestamp"),
            "best_params": F.create_map(F.lit("window"), F.lit("7"), F.lit("store"), F.col("Store").cast("string")),
        })
    )


@query("append_model_metrics", ctes(*PREDICTED) + f"""
select 'v_' || "Store" as model_version, {r('avg(abs("ActualSales" - "PredictedSales") / greatest("ActualSales", 1) * 100)')} as mape,
       {r('sqrt(avg(("ActualSales" - "PredictedSales") * ("ActualSales" - "PredictedSales")))')} as rmse,
       {r('avg(abs("ActualSales" - "PredictedSales"))')} as mae,
       {r('1 - sum(("ActualSales" - "PredictedSales") * ("ActualSales" - "PredictedSales")) / (var_pop("ActualSales") * count(*))')} as r2_score,
       {i("count(*)")} as n_test_samples, '{{"window":"7","store":"' || "Store" || '"}}' as best_params from pred group by "Store\"""")
def append_model_metrics(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "append_model_metrics")
    warehouse.append_metrics(per_store_metrics(spark, sf_dir))
    return plain(warehouse.model_metrics().select(
        "model_version", "mape", "rmse", "mae", "r2_score", "n_test_samples", "best_params"
    ))


@query("backfill", ctes(*PREDICTED) + f"""
select 'sales_history' as "table", '' as version, {i("count(*)")} as records, {r('sum("Sales")')} as total from panel
union all select 'predictions', 'migration_initial', {i("count(*)")}, {r('sum("ActualSales")')} from pred
union all select 'model_metrics', 'migration_lgbm_' || (row_number() over (order by "Store") - 1), {i("count(*)")}, {r('avg(abs("ActualSales" - "PredictedSales"))')}
from pred group by "Store\"""")
def backfill(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "backfill")
    panel, pred = retail.sales_panel(spark, sf_dir, "nation"), retail.predictions(spark, sf_dir)
    error = F.avg(F.abs(F.col("ActualSales") - F.col("PredictedSales")))
    metrics = pred.groupBy("Store").agg(error.alias("MAE"), F.count(F.lit(1)).alias("Samples"))
    warehouse.backfill(panel, pred, metrics, metrics_order="Store")
    tables = warehouse.load_history().agg(
        F.lit("sales_history").alias("table"), F.lit("").alias("version"), F.count(F.lit(1)).alias("records"), F.sum("Sales").alias("total")
    ).unionByName(warehouse.predictions().groupBy(F.col("run_id").alias("version")).agg(
        F.lit("predictions").alias("table"), F.count(F.lit(1)).alias("records"), F.sum("actual_sales").alias("total")
    )).unionByName(warehouse.model_metrics().select(
        F.lit("model_metrics").alias("table"), F.col("model_version").alias("version"), F.col("n_test_samples").alias("records"), F.col("mae").alias("total")
    ))
    return plain(tables)
