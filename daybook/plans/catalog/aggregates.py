"""Metrics, diagnostics, exploratory reports and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.functions import errors
from daybook.operators import cleaning, diagnostics, eda, evaluation, history, rollup
from daybook.plans.catalog.base import (
    CLEANED, KEYS, PANEL, PREDICTED, ctes, forecast, i, plain, query, r, s,
)
from daybook.session import scratch_path
from daybook.sources import retail


def _panel(spark, sf_dir):
    return retail.sales_panel(spark, sf_dir, "nation")


def _pred(spark, sf_dir):
    return retail.predictions(spark, sf_dir)


_E = '"ActualSales" - "PredictedSales"'
_APE = f'case when "ActualSales" > 0 then abs({_E}) / "ActualSales" * 100 end'

# --- history ----------------------------------------------------------------------------------------------


@query("history_stats", ctes(PANEL) + f"""
select {i("count(*)")} as total_records, {i('count(distinct "Store")')} as unique_stores,
       {s('min("Date")')} || ' - ' || {s('max("Date")')} as date_range, {i('max("Date") - min("Date")')} as date_coverage_days from panel""")
def history_stats(spark, sf_dir):
    return plain(history.history_stats(_panel(spark, sf_dir)))


@query("store_stats", ctes(PANEL, 'recent as (select * from panel qualify "Date" >= max("Date") over (partition by "Store") - 365)') + f"""
select {i('"Store"')} as "Store", {i("count(*)")} as records_count, {s('min("Date")')} as date_from, {s('max("Date")')} as date_to,
       {r('avg("Sales")')} as avg_sales, {r('sum("Sales")')} as total_sales, {i('sum("Promo")')} as promo_days,
       {i('''sum(case when "StateHoliday" <> '0' then 1 else 0 end)''')} as holiday_days from recent group by "Store\"""")
def store_stats(spark, sf_dir):
    return plain(history.store_stats(_panel(spark, sf_dir)))


# --- forecast quality -------------------------------------------------------------------------------------

_METRICS = f"""{r(f"avg(abs({_E}))")} as "MAE", {r(f"sqrt(avg(({_E}) * ({_E})))")} as "RMSE",
  {r(f'avg(abs(({_E}) / greatest("ActualSales", 1))) * 100')} as "MAPE",
  {r(f'sqrt(avg((({_E}) / greatest("ActualSales", 1)) * (({_E}) / greatest("ActualSales", 1)))) * 100')} as "RMSPE",
  {r(f'1 - sum(({_E}) * ({_E})) / (var_pop("ActualSales") * count(*))')} as "R2", {r(f"max(abs({_E}))")} as "MaxError",
  {r(f"quantile_cont(abs({_E}), 0.5)")} as "MedAE", {r(f"avg({_E})")} as "Bias", {i("count(*)")} as "Samples\""""


@query("forecast_metrics", ctes(*PREDICTED) + f"select {_METRICS} from pred")
def forecast_metrics(spark, sf_dir):
    return plain(evaluation.forecast_metrics(_pred(spark, sf_dir)))


@query("dashboard_metrics", ctes(*PREDICTED) + f"""
select {r(f"round(coalesce(avg({_APE}), 0), 2)")} as mape, {r(f"round(avg(abs({_E})), 2)")} as mae,
       {r(f"round(sqrt(avg(({_E}) * ({_E}))), 2)")} as rmse, {r('round(sum("ActualSales"), 2)')} as total_sales,
       {r(f"round(avg({_E}), 2)")} as bias, {r(f"round(stddev_pop({_E}), 2)")} as std_error, {i("count(*)")} as data_points
from pred where "ActualSales" is not null and "PredictedSales" is not null""")
def dashboard_metrics(spark, sf_dir):
    return plain(evaluation.dashboard_metrics(_pred(spark, sf_dir)))


def _filtered(name: str, condition: str) -> str:
    return f"""select '{name}' as filter, {r(f"case when count(*) > 0 then round(coalesce(avg({_APE}), 0), 2) end")} as mape, {r(f"round(avg(abs({_E})), 2)")} as mae,
  {r(f"round(sqrt(avg(({_E}) * ({_E}))), 2)")} as rmse, {r('round(sum("ActualSales"), 2)')} as total_sales, {r(f"round(avg({_E}), 2)")} as bias,
  {r(f"round(stddev_pop({_E}), 2)")} as std_error, {i("count(*)")} as data_points
from pred where "ActualSales" is not null and "PredictedSales" is not null and {condition}"""


@query("rollup_metrics", ctes(*PREDICTED) + " union all ".join([
    _filtered("all", "true"), _filtered("store", '"Store" = 3'),
    _filtered("range", "\"Date\" between date '1996-02-10' and date '1997-01-20'")]))
def rollup_metrics(spark, sf_dir):
    """Three filters of the dashboard, from the stored roll-up of the run."""
    path = scratch_path(spark, "roll-up")
    rollup.store_roll_up(_pred(spark, sf_dir), path)
    some = rollup.load_roll_up(spark, path, "1996-02-10", "1997-01-20")
    cells = rollup.load_roll_up(spark, path)
    out = [("all", rollup.metrics(cells)), ("store", rollup.metrics(cells, store=3, preset="all")), ("range", rollup.metrics(some))]
    rows = [df.withColumn("filter", F.lit(name)) for name, df in out]
    return plain(rows[0].unionByName(rows[1]).unionByName(rows[2]))


@query("rollup_by_store", ctes(*PREDICTED) + f"""
select "Store", {r('round(avg("ActualSales"), 2)')} as "AvgSales", {r('round(stddev_samp("ActualSales"), 2)')} as "StdSales",
  {r('round(sum("ActualSales"), 2)')} as "TotalSales", {r('round(avg("PredictedSales"), 2)')} as "AvgPredicted", {r(f"coalesce(avg({_APE}), 0)")} as "MAPE"
from pred where "ActualSales" is not null and "PredictedSales" is not null group by 1""")
def rollup_by_store(spark, sf_dir):
    return plain(rollup.by_store(rollup.roll_up(_pred(spark, sf_dir))))


@query("safe_mape", ctes(*PREDICTED) + f"select {r(f'coalesce(avg({_APE}), 0)')} as mape from pred")
def safe_mape(spark, sf_dir):
    return plain(evaluation.safe_mape(_pred(spark, sf_dir)))


@query("batch_summary", ctes(*PREDICTED) + f"""
select {i("count(*)")} as predictions, {i('count(distinct "Store")')} as stores, {s('min("Date")')} as date_from,
       {s('max("Date")')} as date_to, {r(f"avg(abs({_E}))")} as mae, {r(f"avg(coalesce({_APE}, 0))")} as mape,
       {r(f"quantile_cont(abs({_E}), 0.5)")} as medae from pred""")
def batch_summary(spark, sf_dir):
    return plain(evaluation.batch_summary(_pred(spark, sf_dir)))


_SERIES = 'series as (select "Date", sum("ActualSales") as "ActualSales", sum("PredictedSales") as "PredictedSales" from pred group by 1)'


@query("forecast_series", ctes(*PREDICTED, _SERIES) + f"""
select {s('"Date"')} as "Date", {r('"ActualSales"', 3)} as "ActualSales", {r('"PredictedSales"', 3)} as "PredictedSales" from series""")
def forecast_series(spark, sf_dir):
    return plain(evaluation.forecast_series(_pred(spark, sf_dir)), 3)


@query("forecast_header", ctes(*PREDICTED, _SERIES) + f"""
select {r(f"coalesce(avg({_APE}), 0)")} as mape, {r(f"sqrt(avg(({_E}) * ({_E})))")} as rmse, {i("count(*)")} as points,
       {i('(select count(distinct "Store") from pred)')} as stores from series""")
def forecast_header(spark, sf_dir):
    return plain(evaluation.forecast_header(_pred(spark, sf_dir)))


_COMPARISON = f"""comparison as (select "Store", round(avg("ActualSales"), 2) as a, round(stddev_samp("ActualSales"), 2) as sd,
  round(sum("ActualSales"), 2) as t, round(avg("PredictedSales"), 2) as p, coalesce(avg({_APE}), 0) as m
  from pred where "Date" between date '1998-01-01' and date '1999-12-31' group by 1)"""
_COMPARED = f"""{i('"Store"')} as "Store", {r("a")} as "AvgSales", {r("sd")} as "StdSales", {r("t")} as "TotalSales",
  {r("p")} as "AvgPredicted", {r("m")} as "MAPE\""""


@query("store_comparison", ctes(*PREDICTED, _COMPARISON) + f"select {_COMPARED} from comparison")
def store_comparison(spark, sf_dir):
    return plain(evaluation.store_comparison(_pred(spark, sf_dir), "1998-01-01", "1999-12-31"))


@query("top_stores_plus", ctes(*PREDICTED, _COMPARISON) + f"""
select {_COMPARED} from comparison qualify row_number() over (order by a desc, "Store") <= 15 or "Store" = 24""")
def top_stores_plus(spark, sf_dir):
    compared = evaluation.store_comparison(_pred(spark, sf_dir), "1998-01-01", "1999-12-31")
    return plain(evaluation.top_stores_plus(compared, 24))


@query("prediction_checks", ctes(*PREDICTED) + """
select 1 as has_column, 1 as has_data, cast(bool_and("PredictedSales" >= 0) as bigint) as no_negative,
       cast(bool_and("PredictedSales" is not null) as bigint) as no_nan,
       cast(bool_and("PredictedSales" >= 0) and bool_and("PredictedSales" is not null) as bigint) as all_passed, '' as failed_checks from pred""")
def prediction_checks(spark, sf_dir):
    return plain(evaluation.prediction_checks(_pred(spark, sf_dir)))


@query("mape_quality_band", ctes(*PREDICTED) + f"""
select {i('"Store"')} as "Store", {r("m")} as "MAPE", case when m < 10 then 'excellent' when m < 15 then 'good' else 'poor' end as quality
from (select "Store", avg(abs({_E}) / greatest("ActualSales", 1)) * 100 as m from pred group by 1)""")
def mape_quality_band(spark, sf_dir):
    from daybook.functions.errors import mape_floor_one

    per_store = _pred(spark, sf_dir).groupBy("Store").agg(mape_floor_one(F.col("ActualSales"), F.col("PredictedSales")).alias("MAPE"))
    return plain(evaluation.mape_quality_band(per_store))


@query("forecast_sample", ctes(*PREDICTED) + f"""
select {KEYS}, {r('"ActualSales"')} as "ActualSales", {r('"PredictedSales"')} as "PredictedSales", {r(_E)} as "Error",
       {r(f"(select avg({_E}) from pred)")} as "MeanError" from (select * from pred order by "Store", "Date" limit 100)""")
def forecast_sample(spark, sf_dir):
    return plain(evaluation.forecast_sample(_pred(spark, sf_dir)))


_FORECASTS = {f"mean_{d}": d for d in (1, 7, 14, 28)}


@query("rank_models", ctes(PANEL, *[forecast(n, d) for n, d in _FORECASTS.items()], "metrics as (" + " union all ".join(
    f"select '{n}' as model, avg(abs({_E}) / greatest(\"ActualSales\", 1)) * 100 as mape from {n}" for n in _FORECASTS) + ")") + f"""
select model, {r("mape")} as "MAPE", cast(mape = min(mape) over () as bigint) as is_best,
       cast(mape = max(mape) over () as bigint) as is_worst from metrics""")
def rank_models(spark, sf_dir):
    metrics = None
    for name, days in _FORECASTS.items():
        row = evaluation.forecast_metrics(retail.predictions(spark, sf_dir, days)).select(F.lit(name).alias("model"), "MAPE")
        metrics = row if metrics is None else metrics.unionByName(row)
    return plain(evaluation.rank_models(metrics))


# --- residual diagnostics ---------------------------------------------------------------------------------


@query("residual_percentiles", ctes(*PREDICTED) + f"""
select {", ".join(f'{r(f"quantile_cont(abs({_E}), {p / 100})")} as "P{p}"' for p in (50, 75, 95))} from pred""")
def residual_percentiles(spark, sf_dir):
    return plain(diagnostics.residual_percentiles(_pred(spark, sf_dir)))


@query("residual_trend", ctes(*PREDICTED) + f"""
select {r(f'regr_slope({_E}, "PredictedSales")')} as slope, {r(f'regr_intercept({_E}, "PredictedSales")')} as intercept from pred""")
def residual_trend(spark, sf_dir):
    return plain(diagnostics.residual_trend(_pred(spark, sf_dir)))


_EDGES = 'edges as (select quantile_cont("PredictedSales", [0, 0.2, 0.4, 0.6, 0.8, 1.0]) as e from pred)'
_BINNED = f"""binned as (select ({_E}) as v, (select e from edges) as e, cast("PredictedSales" >= e[2] as int) + cast("PredictedSales" >= e[3] as int)
  + cast("PredictedSales" >= e[4] as int) + cast("PredictedSales" >= e[5] as int) as bin from pred, edges)"""
_BOXES = "boxes as (select bin, quantile_cont(v, [0.25, 0.5, 0.75]) as q from binned group by 1)"


@query("residuals_by_quintile", ctes(*PREDICTED, _EDGES, _BINNED, _BOXES) + f"""
select {i("bin")} as bin, {r("any_value(e[bin + 1])")} as bin_from, {r("any_value(e[bin + 2])")} as bin_to, {i("count(*)")} as n,
       {r("min(v)")} as min, {r("any_value(q[1])")} as q1, {r("any_value(q[2])")} as median, {r("any_value(q[3])")} as q3, {r("max(v)")} as max,
       {r("min(case when v >= q[1] - (q[3] - q[1]) * 1.5 then v end)")} as whisker_low,
       {r("max(case when v <= q[3] + (q[3] - q[1]) * 1.5 then v end)")} as whisker_high
from binned join boxes using (bin) group by bin""")
def residuals_by_quintile(spark, sf_dir):
    return plain(diagnostics.residuals_by_quintile(_pred(spark, sf_dir)))


@query("abs_error_cdf", ctes(*PREDICTED) + f"""
select {r(f"abs({_E})")} as "AbsError", {r(f"row_number() over (order by abs({_E})) / cast(count(*) over () as double) * 100", 8)} as "CumulativePct" from pred""")
def abs_error_cdf(spark, sf_dir):
    return plain(diagnostics.abs_error_cdf(_pred(spark, sf_dir)), special={"CumulativePct": 8})


def _poly(coefficients: tuple[float, ...], x: str) -> str:
    acc = repr(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        acc = f"({acc} * {x} + {c!r})"
    return acc


def _ratio(a: tuple[float, ...], b: tuple[float, ...], x: str) -> str:
    return f"{_poly(a, x)} / {_poly(b, x)}"


_PPF = f"""case when abs(q) <= 0.425 then q * {_ratio(errors._AS241_A, errors._AS241_B, "u")}
  else sign(q) * case when t <= 5 then {_ratio(errors._AS241_C, errors._AS241_D, "(t - 1.6)")} else {_ratio(errors._AS241_E, errors._AS241_F, "(t - 5)")} end end"""


@query("qq_normal", ctes(*PREDICTED, f"""ranked as (select {_E} as v, row_number() over (order by {_E}) as k, cast(count(*) over () as double) as n from pred),
points as (select v, k, case when k = n then pow(0.5, 1 / n) when k = 1 then 1 - pow(0.5, 1 / n) else (k - 0.3175) / (n + 0.365) end as p from ranked),
parts as (select *, p - 0.5 as q, 0.180625 - (p - 0.5) * (p - 0.5) as u, sqrt(-ln(least(p, 1 - p))) as t from points)""") + f"""
select {i("k")} as "Rank", {r(_PPF, 6)} as "Theoretical", {r("v", 6)} as "Residual" from parts""")
def qq_normal(spark, sf_dir):
    return plain(diagnostics.qq_normal(_pred(spark, sf_dir)), 6)


_ACF = f"""centred as (select "Store", row_number() over w as t, ({_E}) - avg({_E}) over (partition by "Store") as z from pred window w as (partition by "Store" order by "Date")),
sizes as (select "Store", count(*) as n, sum(z * z) as p0 from centred group by 1),
acfs as (select a."Store", b.t - a.t as lag, sum(a.z * b.z) as p from centred a join centred b on a."Store" = b."Store" and b.t between a.t and a.t + 60 group by 1, 2)"""


@query("residual_acf", ctes(*PREDICTED, _ACF) + f"""
select {i("lag")} as lag, {r("avg(p / p0)", 6)} as acf, {r("(select 1.96 / sqrt(avg(n)) from sizes)", 6)} as band, {i("count(*)")} as stores_used
from acfs join sizes using ("Store") where n > 61 group by lag""")
def residual_acf(spark, sf_dir):
    return plain(diagnostics.residual_acf(_pred(spark, sf_dir)), 6)


_PCT = f'pct as (select ({_E}) / "ActualSales" * 100 as v from pred where "ActualSales" > 0)'
_PCT_STATS = """pct_q as (select quantile_cont(v, [0.005, 0.01, 0.5, 0.99, 0.995]) as q, count(*) as n from pct),
pct_cut as (select *, (select count(*) from pct where v < q[2] or v > q[4]) as c1, (select count(*) from pct where v < q[1] or v > q[5]) as c2 from pct_q),
pct_range as (select *, case when n < 100 then (select min(v) from pct) when c1 > n * 0.1 then q[1] else q[2] end as lo,
  case when n < 100 then (select max(v) from pct) when c1 > n * 0.1 then q[5] else q[4] end as hi,
  case when n < 100 then 0 when c1 > n * 0.1 then c2 else c1 end as clipped from pct_cut)"""
_SHOWN = "shown as (select v from pct, pct_range where v between lo and hi)"


@query("error_pct_stats", ctes(*PREDICTED, _PCT, _PCT_STATS) + f"""
select {i("n")} as n, {r("(select avg(v) from pct)")} as mean, {r("q[3]")} as median, {r("(select stddev_pop(v) from pct)")} as std,
       {r("(select min(v) from pct)")} as min, {r("(select max(v) from pct)")} as max, {r("lo")} as display_low, {r("hi")} as display_high,
       {i("clipped")} as n_clipped from pct_range""")
def error_pct_stats(spark, sf_dir):
    return plain(diagnostics.error_pct_stats(_pred(spark, sf_dir)))


_SUMMARY = """summary as (select count(*) as n, stddev_samp(v) as sd, min(v) as lo, max(v) as hi,
  quantile_cont(v, 0.25) as q25, quantile_cont(v, 0.75) as q75 from shown)"""
_STURGES = "ceil(1 + log2(greatest(n, 1)))"


@query("adaptive_bins", ctes(*PREDICTED, _PCT, _PCT_STATS, _SHOWN, _SUMMARY) + f"""
select {i("n")} as n, {i(f"case when n < 50 then {_STURGES} else greatest(20, least(80, greatest({_STURGES}, case when q75 - q25 < 1e-9 then 10 else ceil((hi - lo) / (2 * (q75 - q25) * pow(n, -1.0 / 3.0))) end))) end")} as bins from summary""")
def adaptive_bins(spark, sf_dir):
    return plain(diagnostics.adaptive_bins(diagnostics.displayed_error_pct(_pred(spark, sf_dir))))


_WIDTH = "0.9 * greatest(case when q75 - q25 > 1e-9 then least(sd, (q75 - q25) / 1.34) else sd end, 1e-6) * pow(n, -0.2)"


@query("kde", ctes(*PREDICTED, _PCT, _PCT_STATS, _SHOWN, _SUMMARY, f"""params as (select n, {_WIDTH} as w, lo - (hi - lo) * 0.05 as x0,
  ((hi + (hi - lo) * 0.05) - (lo - (hi - lo) * 0.05)) / 199 as step from summary)""") + f"""
select {i("g")} as point, {r("any_value(x0 + g * step)")} as x,
       {r("sum(exp(-0.5 * pow((x0 + g * step - v) / w, 2))) / any_value(n * w * sqrt(2 * pi()))", 8)} as density
from shown, params, range(200) t(g) group by g""")
def kde(spark, sf_dir):
    return plain(diagnostics.kde(diagnostics.displayed_error_pct(_pred(spark, sf_dir))), special={"density": 8})


# --- exploratory ------------------------------------------------------------------------------------------


@query("sales_by_weekday", ctes(PANEL) + f"""
select {i('"DayOfWeek"')} as "DayOfWeek", {r('avg("Sales")')} as mean, {r('stddev_samp("Sales")')} as std, {i("count(*)")} as count
from panel group by "DayOfWeek\"""")
def sales_by_weekday(spark, sf_dir):
    return plain(eda.sales_by_weekday(_panel(spark, sf_dir)))


@query("promo_effect", ctes(PANEL) + f"""
select {i('"Promo"')} as "Promo", {r('avg("Sales")')} as mean, {i("count(*)")} as count,
       {r('((select avg("Sales") from panel where "Promo" = 1) / (select avg("Sales") from panel where "Promo" = 0) - 1) * 100')} as diff_percent
from panel group by "Promo\"""")
def promo_effect(spark, sf_dir):
    return plain(eda.promo_effect(_panel(spark, sf_dir)))


@query("monthly_seasonality", ctes(PANEL) + f"""select {i('month("Date")')} as "Month", {r('avg("Sales")')} as mean from panel group by 1""")
def monthly_seasonality(spark, sf_dir):
    return plain(eda.monthly_seasonality(_panel(spark, sf_dir)))


@query("store_ranking", ctes(PANEL) + f"""
select {i('"Store"')} as "Store", {r('avg("Sales")')} as mean, {r('stddev_samp("Sales")')} as std, {i("count(*)")} as count
from panel group by "Store\"""")
def store_ranking(spark, sf_dir):
    return plain(eda.store_ranking(_panel(spark, sf_dir)))


@query("sales_summary", ctes(PANEL) + f"""
select {r('avg("Sales")')} as mean, {r('quantile_cont("Sales", 0.5)')} as median, {r('stddev_samp("Sales")')} as std,
       {r('min("Sales")')} as min, {r('max("Sales")')} as max from panel""")
def sales_summary(spark, sf_dir):
    return plain(eda.sales_summary(_panel(spark, sf_dir)))


@query("dataset_overview", ctes(PANEL) + f"""
select {i("count(*)")} as rows, 9 as columns, {i('count(distinct "Store")')} as stores, {i('sum("Promo")')} as promo_rows,
       {r('avg("Promo") * 100')} as promo_pct, {s('min("Date")')} as date_from, {s('max("Date")')} as date_to,
       {i('max("Date") - min("Date")')} as days from panel""")
def dataset_overview(spark, sf_dir):
    return plain(eda.dataset_overview(_panel(spark, sf_dir)))


_CORR = ("Store", "Sales", "Customers", "Promo", "DayOfWeek", "SchoolHoliday")
_NUMERIC = "numeric as (select {} from panel)".format(", ".join(f'cast("{c}" as double) as "{c}"' for c in _CORR))


def _cell(a: str, b: str) -> str:
    if a == b:
        return f"select '{a}' as a, '{b}' as b, {r('1.0', 6)} as corr"
    return f"select '{a}' as a, '{b}' as b, {r(f'corr(\"{a}\", \"{b}\")', 6)} as corr from numeric"


@query("correlation_matrix", ctes(PANEL, _NUMERIC) + " union all ".join(_cell(a, b) for a in _CORR for b in _CORR))
def correlation_matrix(spark, sf_dir):
    return plain(eda.correlation_matrix(_panel(spark, sf_dir), _CORR), 6)


_OTHERS = ("Store", "Customers", "Promo", "DayOfWeek", "SchoolHoliday")


@query("correlation_with_sales", ctes(PANEL, _NUMERIC) + "select * from (" + " union all ".join(
    f"select '{c}' as feature, {r(f'corr(\"{c}\", \"Sales\")', 6)} as corr from numeric" for c in _OTHERS) + ") where abs(corr) > 0.1")
def correlation_with_sales(spark, sf_dir):
    return plain(eda.correlation_with(_panel(spark, sf_dir).drop("Open")), 6)


_HIST = """span as (select min("Sales") as lo, max("Sales") as hi from panel),
counts as (select least(floor(("Sales" - lo) / (hi - lo) * 50), 49) as b, count(*) as n from panel, span group by 1)"""


@query("histogram", ctes(PANEL, _HIST) + f"""
select {i("g")} as bin, {r("lo + g * (hi - lo) / 50")} as bin_from, {r("lo + (g + 1) * (hi - lo) / 50")} as bin_to, {i("coalesce(n, 0)")} as n
from range(50) t(g) cross join span left join counts on b = g""")
def histogram(spark, sf_dir):
    return plain(diagnostics.histogram(_panel(spark, sf_dir), 50, "Sales"))


@query("iqr_outlier_count", ctes(PANEL, 'q as (select quantile_cont("Sales", 0.25) as q1, quantile_cont("Sales", 0.75) as q3 from panel)') + f"""
select {i('count(*) filter ("Sales" < q1 - (q3 - q1) * 1.5 or "Sales" > q3 + (q3 - q1) * 1.5)')} as outliers,
       {r('count(*) filter ("Sales" < q1 - (q3 - q1) * 1.5 or "Sales" > q3 + (q3 - q1) * 1.5) * 100 / cast(count(*) as double)')} as outliers_pct from panel, q""")
def iqr_outlier_count(spark, sf_dir):
    return plain(eda.iqr_outlier_count(_panel(spark, sf_dir)))


_REGIME = """regime as (select "Promo", avg("Sales") as m, stddev_samp("Sales") as sd, quantile_cont("Sales", 0.25) as q1,
  quantile_cont("Sales", 0.75) as q3 from clean group by 1)"""


@query("detect_outliers", ctes(*CLEANED, _REGIME) + f"""
select {i('c."Store"')} as "Store", {s('c."Date"')} as "Date", {i('case when abs((c."Sales" - m) / sd) > 2 then 1 else 0 end')} as "IsOutlier"
from clean c join regime g on c."Promo" = g."Promo\"""")
def detect_outliers(spark, sf_dir):
    from daybook.plans.jobs import clean_job

    cleaned = clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"])
    return plain(cleaning.detect_outliers(cleaned, method="zscore", threshold=2.0).select("Store", "Date", "IsOutlier"))


_FLAGGED = """flagged as (select c."Sales" as v, c."Sales" < q1 - 0.5 * (q3 - q1) or c."Sales" > q3 + 0.5 * (q3 - q1) as odd
  from clean c join regime g on c."Promo" = g."Promo")"""


@query("outlier_stats", ctes(*CLEANED, _REGIME, _FLAGGED) + f"""
select {i("count(*)")} as total_records, {i("count(*) filter (odd)")} as outliers_count,
       {r("count(*) filter (odd) * 100 / cast(count(*) as double)")} as outliers_percentage, 'iqr' as method, {r("0.5")} as threshold,
       {r("min(v) filter (not odd)")} as normal_min, {r("max(v) filter (not odd)")} as normal_max, {r("avg(v) filter (not odd)")} as normal_mean,
       {r("min(v) filter (odd)")} as outlier_min, {r("max(v) filter (odd)")} as outlier_max, {r("avg(v) filter (odd)")} as outlier_mean,
       {r("quantile_cont(v, 0.5) filter (not odd)")} as normal_median from flagged""")
def outlier_stats(spark, sf_dir):
    from daybook.plans.jobs import clean_job

    return plain(cleaning.outlier_stats(clean_job(retail.sales_raw(spark, sf_dir), ["ingest_seq"]), threshold=0.5))


_CASE = eda.BusinessCase()


@query("business_value", ctes(PANEL, f"""base as (select count(distinct "Store") as k, avg("Sales") as a, {_CASE.target_stores * _CASE.working_days} * avg("Sales") as rev
  from panel where "Sales" > 0)""", f"""
val as (select *, rev * {_CASE.loss_rate!r} * 25 / 100 as l0, rev * {_CASE.loss_rate!r} * 9.7 / 100 as l1 from base),
sav as (select *, (l0 - l1) * {_CASE.realization} as sv from val), net as (select *, sv * 100 - {_CASE.yearly_cost!r} as ne from sav)""") + f"""
select {i("k")} as n_stores, {r("a")} as avg_daily_revenue, {r("rev", 2)} as annual_revenue, {r("l0", 2)} as annual_loss_baseline,
       {r("l1", 2)} as annual_loss_model, {r("sv", 2)} as annual_saving, {r("ne", 2)} as net_effect,
       {r(f"ne / {_CASE.development_cost!r} * 100")} as roi_pct, {r(f"case when ne > 0 then {_CASE.development_cost!r} / ne * 12 end")} as payback_months from net""")
def business_value(spark, sf_dir):
    money = ("annual_revenue", "annual_loss_baseline", "annual_loss_model", "annual_saving", "net_effect")
    return plain(eda.business_value(_panel(spark, sf_dir), 9.7), special={c: 2 for c in money})
