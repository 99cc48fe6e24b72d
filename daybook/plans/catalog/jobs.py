"""End-to-end jobs."""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from daybook.ml import models
from daybook.operators import eda, joins, panel, runs
from daybook.operators.observed import Steps
from daybook.plans import jobs
from daybook.plans.catalog.base import (
    CLEANED, KEYS, MERGED, PANEL, STORE_DIM, ctes, fill_sql, i, lag_sql, plain, query, r, s,
)
from daybook.plans.catalog.tables import _LAST, _LOG, fresh_warehouse
from daybook.plans.features import build_features, feature_names
from daybook.session import scratch_path
from daybook.sources import files, retail
from daybook.streaming.incremental import incremental_history

_CLEAN = f"""{KEYS}, {r('"Sales"')} as "Sales", {r('"Customers"')} as "Customers", {i('"Open"')} as "Open", {i('"Promo"')} as "Promo",
  {i('"DayOfWeek"')} as "DayOfWeek", "StateHoliday", {r('"SchoolHoliday"')} as "SchoolHoliday\""""


@query("clean_job", ctes(*CLEANED) + f"select {_CLEAN} from clean")
def clean_job(spark, sf_dir):
    cleaned = jobs.clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"])
    return plain(cleaned.withColumn("SchoolHoliday", F.col("SchoolHoliday").cast("double")))


_LEFT = """kept as (select 'read' as step, 0 as number, count(*) as n from coerced union all select 'unique', 1, count(*) from deduped
  union all select 'dated', 2, count(*) from deduped where try_cast("Date" as date) is not null
  union all select 'open', 3, count(*) from deduped where try_cast("Date" as date) is not null and "Open" = 1
  union all select 'positive', 4, count(*) from clean)"""


@query("clean_steps", ctes(*CLEANED, _LEFT) + """
select cast(number as bigint) as number, step, cast(n as bigint) as rows, cast(coalesce(lag(n) over (order by number) - n, 0) as bigint) as removed from kept""")
def clean_steps(spark, sf_dir):
    """Rows that each cleaning step leaves and removes, counted while the cleaned rows are written."""
    steps = Steps()
    files.sink_stage(jobs.clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"], check_fractions=False, steps=steps), scratch_path(spark, "cleaned"))
    return plain(steps.removed(spark))


# --- the feature table ------------------------------------------------------------------------------------

_W = '(partition by "Store" order by "Date")'
_SO_FAR = '(partition by "Store" order by "Date" rows between unbounded preceding and current row)'


def _flag(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


_IMPUTED = """imputed as (select * replace (coalesce("CompetitionDistance", 100000) as "CompetitionDistance",
    coalesce("CompetitionOpenSinceMonth", 0) as "CompetitionOpenSinceMonth", coalesce("CompetitionOpenSinceYear", 0) as "CompetitionOpenSinceYear",
    coalesce("Promo2SinceWeek", 0) as "Promo2SinceWeek", coalesce("Promo2SinceYear", 0) as "Promo2SinceYear"),
  case when "CompetitionOpenSinceYear" is not null then 1 else 0 end as "HasCompetition",
  case when "Promo2SinceYear" is not null then 1 else 0 end as "InPromo2",
  case when "StateHoliday" <> '0' then 1 else 0 end as "IsHoliday" from merged)"""
_MONTHS = """greatest((year("Date") - "CompetitionOpenSinceYear") * 12 + month("Date") - "CompetitionOpenSinceMonth", 0)"""
_STAGED = f"""staged as (select *, {", ".join(lag_sql())},
  {_flag(f'lag("Promo") over {_W} is null or lag("Promo") over {_W} <> "Promo"')} as chg,
  case when "Promo" = 1 then 0 else coalesce("Date" - max(case when "Promo" = 1 then "Date" end) over {_SO_FAR}, 999) end as "DaysSinceLastPromo",
  {_flag(f'"Promo" = 1 and lag("Promo") over {_W} = 0')} as "IsPromoStart", {_flag(f'"Promo" = 0 and lag("Promo") over {_W} = 1')} as "IsPromoEnd",
  lag("IsHoliday", 1, 0) over {_W} as "WasHolidayYesterday", lead("IsHoliday", 1, 0) over {_W} as "IsHolidayTomorrow",
  coalesce(max("IsHoliday") over (partition by "Store" order by "Date" rows between 7 preceding and 1 preceding), 0) as "WasHolidayLastWeek"
  from imputed), sequenced as (select *, sum(chg) over {_SO_FAR} as seq from staged)"""
_ROW = {
    "Year": 'year("Date")', "Month": 'month("Date")', "Week": 'weekofyear("Date")', "ISOYear": 'extract(isoyear from "Date")',
    "Day": 'day("Date")', "DayOfYear": 'dayofyear("Date")',
    "IsSaturday": _flag('"DayOfWeek" = 6'), "IsSunday": _flag('"DayOfWeek" = 7'), "IsWeekend": _flag('"DayOfWeek" >= 6'),
    **{f"{n}_{f}": f"{f}({2 * math.pi!r} * {v} / {p})" for n, v, p in (
        ("Month", 'month("Date")', 12), ("DayOfWeek", '"DayOfWeek"', 7), ("DayOfMonth", 'day("Date")', 31)) for f in ("sin", "cos")},
    "IsSpring": _flag('month("Date") in (3, 4, 5)'), "IsSummer": _flag('month("Date") in (6, 7, 8)'),
    "IsAutumn": _flag('month("Date") in (9, 10, 11)'), "IsWinter": _flag('month("Date") in (12, 1, 2)'),
    "IsMonthStart": _flag('day("Date") <= 5'), "IsMonthEnd": _flag('day("Date") >= 25'),
    "IsYearStart": _flag('month("Date") = 1 and day("Date") <= 7'), "IsYearEnd": _flag('month("Date") = 12 and day("Date") >= 25'),
    "IsPublicHoliday": _flag("\"StateHoliday\" = 'a'"), "IsEaster": _flag("\"StateHoliday\" = 'b'"),
    "IsChristmas": _flag("\"StateHoliday\" = 'c'"),
    **{f"StoreType_{v}": _flag(f"\"StoreType\" = '{v}'") for v in "abcd"},
    **{f"Assortment_{v}": _flag(f"\"Assortment\" = '{v}'") for v in "abc"},
    "CompetitionOpenMonths": _MONTHS, "CompetitionOpen": _flag(f"{_MONTHS} > 0"),
    "CompetitionNear": _flag('"CompetitionDistance" < 1000'),
    "CompetitionMedium": _flag('"CompetitionDistance" >= 1000 and "CompetitionDistance" < 5000'),
    "CompetitionFar": _flag('"CompetitionDistance" >= 5000'),
    "PromoSequenceLength": 'case when "Promo" = 1 then row_number() over (partition by "Store", seq order by "Date") else 0 end',
}
_LAGS = panel.lag_columns()
_FILLS = dict(zip(_LAGS, (f.rsplit(" as ", 1)[0] for f in fill_sql(_LAGS))))
# Expanding statistics of statistics: fewer places, and away from exact rounding ties.
_DIGITS = {c: 1 if c.startswith("RollingStd") else 4 for c in _LAGS}
_SHIFT = 0.0000317


def _feature_sql(name: str) -> str:
    if name in _FILLS:
        return f'{r(f"{_FILLS[name]} + {_SHIFT}", _DIGITS[name])} as "{name}"'
    return f'{r(_ROW.get(name, f"\"{name}\""), 6)} as "{name}"'


@query("feature_job", ctes(PANEL, STORE_DIM, MERGED, _IMPUTED, _STAGED) + f"""
select {", ".join(_feature_sql(n) for n in feature_names() if n != "Store")}, {r('"Store"')} as "Store", {s('"Date"')} as "Date", {r('"Sales"')} as "Sales" from sequenced""")
def feature_job(spark, sf_dir):
    built = jobs.feature_job(retail.merged_panel(spark, sf_dir))
    shifted = built.select(*[
        (F.col(n) + F.lit(_SHIFT)).alias(n) if n in _FILLS else F.col(n).cast("double").alias(n) for n in feature_names()
    ], "Sales", "Date")
    return plain(shifted, 6, _DIGITS)


def _plain_feature(name: str) -> str:
    column = f'"{name}"'
    return f'cast({_FILLS.get(name) or _ROW.get(name, column)} as double) as "{name}"'


_ORDER = feature_names()
_PAIRS = [(a, b) for k, a in enumerate(_ORDER) for b in _ORDER[k + 1 :]]
_WIDE = "wide as (select " + ", ".join(
    [f'case when stddev_pop("{a}") > 0 and stddev_pop("{b}") > 0 then corr("{a}", "{b}") end as "{a} {b}"' for a, b in _PAIRS]
    + [f'case when stddev_pop("{a}") > 0 then 1.0::double end as "{a} {a}"' for a in _ORDER]
) + " from features)"


@query("feature_correlations", ctes(PANEL, STORE_DIM, MERGED, _IMPUTED, _STAGED, f"features as (select {', '.join(map(_plain_feature, _ORDER))} from sequenced)",
    _WIDE, "long as (from wide unpivot include nulls (corr for pair in (columns(*))))") + f"""
select split_part(pair, ' ', 1) as a, split_part(pair, ' ', 2) as b, {r("corr + 0.00000037", 5)} as corr from long
union all select split_part(pair, ' ', 2), split_part(pair, ' ', 1), {r("corr + 0.00000037", 5)} from long where split_part(pair, ' ', 1) <> split_part(pair, ' ', 2)""")
def feature_correlations(spark, sf_dir):
    """All pairs of all features of the panel."""
    built = jobs.feature_job(retail.merged_panel(spark, sf_dir))
    found = eda.correlation_matrix(built, feature_names())
    return plain(found.withColumn("corr", F.col("corr") + F.lit(0.00000037)), 5)


_GAPS = ("CompetitionDistance", "CompetitionOpenSinceMonth", "CompetitionOpenSinceYear", "Promo2SinceWeek", "Promo2SinceYear", "PromoInterval")


def _nulls(step: str, names: tuple, source: str) -> str:
    counts = ", ".join(f'count(*) filter (where "{c}" is null) as "{c}"' for c in names)
    return f"select '{step}' as step, name as column, cast(n as bigint) as nulls from (unpivot (select {counts} from {source}) on columns(*) into name name value n)"


@query("feature_nulls", ctes(PANEL, STORE_DIM, MERGED, _IMPUTED, _STAGED, f"features as (select {', '.join(map(_plain_feature, _ORDER))} from sequenced)")
    + _nulls("before", _GAPS, "merged") + " union all " + _nulls("after", tuple(_ORDER), "features"))
def feature_nulls(spark, sf_dir):
    """Nulls before and after the feature job, counted while the features are written."""
    steps = Steps()
    files.sink_stage(jobs.feature_job(retail.merged_panel(spark, sf_dir), steps=steps), scratch_path(spark, "features"))
    wanted = F.col("column").isin(*_GAPS) & (F.col("step") == "before") | F.col("column").isin(*_ORDER) & (F.col("step") == "after")
    return plain(steps.nulls(spark).where(wanted))


# --- history, prediction, validation ----------------------------------------------------------------------


@query("history_job", ctes(*CLEANED) + f"""
select {i("count(*)")} as total_records, {i('count(distinct "Store")')} as unique_stores,
       {s('min("Date")')} || ' - ' || {s('max("Date")')} as date_range, {i('max("Date") - min("Date")')} as date_coverage_days from clean""")
def history_job(spark, sf_dir):
    cleaned = jobs.clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"])
    return plain(jobs.history_job(fresh_warehouse(spark, "history_job"), cleaned))


_MEAN_28 = """lagged as (select *, avg("Sales") over (partition by "Store" order by "Date"
  range between interval 28 days preceding and interval 1 days preceding) as m from clean)"""
_SCORED = f"""scored as (select "Store", "Date", "Sales" as a, coalesce(m, avg(m) over {_SO_FAR}, 0) as p from lagged)"""


def _predict(spark, sf_dir, name):
    merged = joins.join_store_dim(
        retail.sales_raw(spark, sf_dir).withColumn("Store", F.col("Store").cast("int")), retail.store_dim(spark, sf_dir)
    )
    return jobs.predict_job(
        merged, ["ingest_seq"], fresh_warehouse(spark, name), lambda df: df.withColumn("PredictedSales", F.col("RollingMean_28")), run_id="run_a"
    )[1]


@query("predict_job", ctes(*CLEANED, _MEAN_28, _SCORED) + f"""
select {KEYS}, {r("a")} as "ActualSales", {r("p")} as "PredictedSales", {r("abs(a - p)")} as "AbsoluteError",
       {r("case when a > 0 then abs(a - p) / a * 100 else 0 end")} as "PercentageError" from scored""")
def predict_job(spark, sf_dir):
    """As-of-day-ahead scoring with the 28-day mean of the stored history as the model."""
    return plain(_predict(spark, sf_dir, "predict_job"))


@query("validate_job", ctes(*CLEANED, _MEAN_28, _SCORED) + """
select 1 as has_column, cast(count(*) > 0 as bigint) as has_data, cast(bool_and(p >= 0) as bigint) as no_negative,
       cast(bool_and(p is not null) as bigint) as no_nan, cast(count(*) > 0 and bool_and(p >= 0) as bigint) as all_passed, '' as failed_checks from scored""")
def validate_job(spark, sf_dir):
    return plain(jobs.validate_job(_predict(spark, sf_dir, "validate_job")))


@query("run_report", ctes(_LOG, _LAST.format(50)) + f"""
select {i("count(*)")} as total_runs, {i("count(*) filter (status = 'success')")} as successful_runs,
       {r("avg(case when status = 'success' then 1.0 else 0.0 end) * 100")} as success_rate,
       (select {r("avg(duration)")} from (select * from last_runs order by started_at desc, run_id desc limit 10)) as average_duration,
       (select {i("count(*) filter (status = 'failed')")} from (select * from last_runs order by started_at desc, run_id desc limit 10)) as recent_failures,
       1 as training_data_exists, 0 as model_exists, 1 as predictions_exist from last_runs""")
def run_report(spark, sf_dir):
    """The part of the report that does not depend on the clock."""
    inventory = files.file_inventory(spark, {
        "train": f"{sf_dir}/lineitem.parquet", "model": f"{sf_dir}/none", "predictions": f"{sf_dir}/orders.parquet",
    })
    return plain(runs.run_report(retail.run_log(spark, sf_dir), inventory).drop(
        "failed_runs", "data_freshness_hours", "health_score", "health_status"
    ))


_DATED = """dated as (select 'train' as name, n, 30 as age from (select count(*) as n from clean) union all select 'model', 1, 2
  union all select 'predictions', (select count(*) from clean), 23)"""


def _dated_copies(spark, sf_dir):
    """Datasets whose files carry fixed times before `now`, which is the day after the last sale: folder by name, and now."""
    cleaned = jobs.clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"])
    last = retail.table(spark, sf_dir, "lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).first()[0]
    now = datetime.combine(last, datetime.min.time()) + timedelta(days=1)
    paths = {name: scratch_path(spark, name) for name in ("train", "predictions", "model")}
    files.sink_stage(cleaned, paths["train"])
    files.sink_stage(files.scan_stage(spark, paths["train"]).select("Store", "Date", F.col("Sales").alias("PredictedSales"), "Sales"), paths["predictions"])
    files.sink_stage(spark.createDataFrame([(len(feature_names()),)], "n_features int"), paths["model"])
    for name, hours in (("train", 30), ("predictions", 23), ("model", 2)):
        files.set_modified(spark, paths[name], now - timedelta(hours=hours))
    return paths, F.timestamp_seconds(F.lit(int(now.replace(tzinfo=timezone.utc).timestamp())))


@query("run_report_whole", ctes(_LOG, _LAST.format(50), "recent as (select * from last_runs order by started_at desc, run_id desc limit 10)") + f"""
select {i("count(*)")} as total_runs, {i("count(*) filter (status = 'success')")} as successful_runs,
       {r("avg(case when status = 'success' then 1.0 else 0.0 end) * 100")} as success_rate, (select {r("avg(duration)")} from recent) as average_duration,
       (select {i("count(*) filter (status = 'failed')")} from recent) as recent_failures,
       (select coalesce(string_agg(run_id, ',' order by started_at, run_id) filter (status = 'failed'), '') from recent) as failed_runs,
       1 as training_data_exists, 1 as model_exists, 1 as predictions_exist, {r("30")} as data_freshness_hours, 75 as health_score, 'healthy' as health_status from last_runs""")
def run_report_whole(spark, sf_dir):
    """The whole report, at a fixed time and over datasets of fixed age: train, model and predictions there, train 30 hours old."""
    paths, now = _dated_copies(spark, sf_dir)
    report = runs.run_report(retail.run_log(spark, sf_dir), files.file_inventory(spark, paths), now)
    return plain(report)


@query("gates_at_a_fixed_time", ctes(*CLEANED, _DATED) + f"""
select name, cast(age < 24 as bigint) as fresh, {r("age")} as age_hours, cast(case when name = 'model' then null else n end as bigint) as rows,
  cast(name = 'train' and (select max(age) from dated where name = 'model') > age as bigint) as retrain from dated""")
def gates_at_a_fixed_time(spark, sf_dir):
    """Freshness of dated datasets, their rows, and whether features newer than the model ask for a training."""
    paths, now = _dated_copies(spark, sf_dir)
    aged = files.freshness(files.file_inventory(spark, paths), 24.0, now).select("name", "fresh", "age_hours")
    counts = [files.scan_stage(spark, paths[n]).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("rows")) for n in ("train", "predictions")]
    asked = files.retrain_gate(spark, paths["model"], paths["train"])
    out = aged.join(counts[0].unionByName(counts[1]), "name", "left")
    return plain(out.withColumn("retrain", (F.col("name") == "train") & F.lit(asked)))


_TOTAL = " + ".join(f'{k + 1} * "{n}"' for k, n in enumerate(_ORDER))


@query("assemble_features", ctes(PANEL, STORE_DIM, MERGED, _IMPUTED, _STAGED, f"features as (select {', '.join(map(_plain_feature, _ORDER))}, \"Date\" from sequenced)") + f"""
select {i('"Store"')} as "Store", {s('"Date"')} as "Date", {i(str(len(_ORDER)))} as n_features, {r(f"{_TOTAL} + 0.317", 0)} as total from features""")
def assemble_features(spark, sf_dir):
    """The vector of all features: its length and the sum of its elements, weighted by their places."""
    from pyspark.ml.functions import vector_to_array

    rows = models.assemble(jobs.feature_job(retail.merged_panel(spark, sf_dir)), feature_names())
    vector = vector_to_array("features")
    total = F.aggregate(F.transform(vector, lambda x, k: x * (k + 1)), F.lit(0.0), lambda a, b: a + b)
    return plain(rows.select("Store", "Date", F.size(vector).alias("n_features"), (total + 0.317).alias("total")), 0)


@query("step_log", ctes(*CLEANED) + f"""
select 'preprocess' as dag_name, 'success' as status, {i("count(*)")} as records_processed, '' as error from clean
union all select 'create_features', 'success', {i("count(*)")}, '' from clean
union all select 'train_model', 'failed', 0, 'no dataset'""")
def step_log(spark, sf_dir):
    warehouse = fresh_warehouse(spark, "step_log")
    log = jobs.StepLog(warehouse)
    staged, built = scratch_path(spark, "step-log"), scratch_path(spark, "step-log-features")

    def preprocess():
        files.sink_stage(jobs.clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"]), staged)
        return {"records_processed": files.scan_stage(spark, staged).count()}

    def create_features():
        files.sink_stage(build_features(files.scan_stage(spark, staged)), built)
        return {"records_processed": files.scan_stage(spark, built).count()}

    def train_model():
        raise FileNotFoundError("no dataset")

    log.run("preprocess", preprocess)
    log.run("create_features", create_features)
    try:
        log.run("train_model", train_model)
    except FileNotFoundError:
        pass
    return plain(warehouse.pipeline_runs().select(
        "dag_name", "status", F.coalesce("records_processed", F.lit(0)).alias("records_processed"),
        F.coalesce("error_message", F.lit("")).alias("error"),
    ))


@query("incremental_history", ctes(*CLEANED) + f"""
select {KEYS}, {r('"Sales"')} as "Sales", {i('"Promo"')} as "Promo", "StateHoliday", {i('coalesce("SchoolHoliday", 0)')} as "SchoolHoliday" from clean""")
def incremental_history_query(spark, sf_dir):
    """The raw table lands as files and streams into the history."""
    landing = scratch_path(spark, "landing")
    files.sink_stage(retail.sales_raw(spark, sf_dir), landing)
    schema = spark.read.parquet(landing).schema
    warehouse = fresh_warehouse(spark, "incremental_history")
    stream = spark.readStream.schema(schema).parquet(landing)
    incremental_history(stream, warehouse, scratch_path(spark, "stream"), ["ingest_seq"]).awaitTermination()
    return plain(warehouse.load_history().select("Store", "Date", "Sales", "Promo", "StateHoliday", "SchoolHoliday"))
