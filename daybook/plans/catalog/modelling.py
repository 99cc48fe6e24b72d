"""Splits, models, scoring and comparison over the feature table of the whole panel.

Forests have the library's 100 trees, the search its 10 trials and 3 folds. Boosting has the library's defaults (10,000 rounds
at most, a patience of 75), in the search too, so a training takes long. A model is trained once per session and table, stored, and shared by the entries that only use it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG
from daybook.ml import models, split, training
from daybook.operators.evaluation import forecast_metrics
from daybook.plans.catalog.base import KEYS, PANEL, ctes, i, plain, query, r
from daybook.plans.catalog.tables import fresh_warehouse
from daybook.plans.features import build_features
from daybook.session import scratch_path
from daybook.sources import files, retail

FOREST = models.ForestSettings()
BOOST = models.BoostSettings()


def staged_features(spark, sf_dir):
    """The feature table, written once: training reads it many times."""
    path = scratch_path(spark, "features")
    files.sink_stage(build_features(retail.merged_panel(spark, sf_dir)), path)
    return files.scan_stage(spark, path)


_WEEKS = """keyed as (select *, cast(extract(isoyear from "Date") as int) * 100 + weekofyear("Date") as k from panel),
weeks as (select k, row_number() over (order by k) - 1 as w, count(*) over () as n from (select distinct k from keyed)),
cut as (select k as pk from weeks where w = floor(n * 0.8))"""


@query("time_split", ctes(PANEL, _WEEKS) + f"""
select {KEYS}, {i("k")} as "WeekKey", {i("k <= pk")} as "IsTrain" from keyed, cut""")
def time_split(spark, sf_dir):
    labelled = split.label_split(retail.sales_panel(spark, sf_dir, "nation"), 0.8)
    return plain(labelled.select("Store", "Date", split.WEEK, "IsTrain"))


@query("cv_folds", ctes(PANEL, _WEEKS, "folds as (select cast(g as int) as fold, cast(floor((select max(n) from weeks) / 4) as int) as size from range(3) t(g))") + f"""
select {i("fold")} as fold, {i("k")} as "WeekKey", case when w < n - (3 - fold) * size then 'train' else 'validation' end as role
from weeks, folds where w < n - (3 - fold) * size + size""")
def cv_folds(spark, sf_dir):
    return plain(split.fold_table(retail.sales_panel(spark, sf_dir, "nation"), 3))


@query("assemble", ctes(PANEL) + f"""
select {KEYS}, {r('ln(1 + "Sales")', 6)} as label, {i('4')} as n_features, {r('"DayOfWeek"')} as f0, {r('"Promo"')} as f1 from panel""")
def assemble(spark, sf_dir):
    from pyspark.ml.functions import vector_to_array

    rows = models.assemble(retail.sales_panel(spark, sf_dir, "nation"), ["DayOfWeek", "Promo", "SchoolHoliday", "Store"], log=True)
    vector = vector_to_array("features")
    return plain(rows.select("Store", "Date", "label", F.size(vector).alias("n_features"), vector[0].alias("f0"), vector[1].alias("f1")), 6)


_METRIC_COLUMNS = ("model", "MAE", "RMSE", "MAPE", "RMSPE", "R2", "MaxError", "MedAE", "Bias", "Samples")


@query("baselines")
def baselines(spark, sf_dir):
    train, test = split.time_split(staged_features(spark, sf_dir))
    return plain(models.baselines(train, test, FOREST)[0].select(*_METRIC_COLUMNS, "error"))


_E = '"Sales" - m'


@query("mean_baseline", ctes(PANEL, _WEEKS, 'mean as (select avg("Sales") as m from keyed, cut where k <= pk)') + f"""
select {r(f"avg(abs({_E}))")} as "MAE", {r(f"sqrt(avg(({_E}) * ({_E})))")} as "RMSE", {r(f'avg(abs({_E}) / greatest("Sales", 1)) * 100')} as "MAPE",
       {r(f'1 - sum(({_E}) * ({_E})) / (var_pop("Sales") * count(*))')} as "R2", {r(f"quantile_cont(abs({_E}), 0.5)")} as "MedAE",
       {r(f"avg({_E})")} as "Bias", {i("count(*)")} as "Samples" from keyed, cut, mean where k > pk""")
def mean_baseline(spark, sf_dir):
    train, test = split.time_split(retail.sales_panel(spark, sf_dir, "nation"))
    metrics = forecast_metrics(models.score_mean(train, test))
    return plain(metrics.select("MAE", "RMSE", "MAPE", "R2", "MedAE", "Bias", "Samples"))


@query("boosted_trees")
def boosted_trees(spark, sf_dir):
    train, test = split.time_split(staged_features(spark, sf_dir))
    return plain(models.train_boosted(train, test, BOOST).metrics.select(*_METRIC_COLUMNS))


@query("nested_holdout", ctes(PANEL, _WEEKS, """own as (select k, row_number() over (order by k) - 1 as w, count(*) over () as n
  from (select distinct k from keyed, cut where k <= pk)), first_held as (select k as hk from own where w = floor(n * 0.85))""") + f"""
select {i("count(*) filter (k < hk)")} as search_rows, {i("count(*) filter (k >= hk)")} as holdout_rows, {i("1")} as refit_matches
from keyed, cut, first_held where k <= pk""")
def nested_holdout(spark, sf_dir):
    """Sizes of the nested holdout; the refit has as many trees as its best round."""
    train, _ = split.time_split(staged_features(spark, sf_dir))
    rows = models.assemble(split.with_week_key(train), models.model_columns(train), log=True)
    search, holdout = split.holdout_split(rows)
    early, late = split.week_keys(search), split.week_keys(holdout)
    table = models.bin_rows(rows)
    run = models.fit_with_stop(table, (early[0], early[-1]), (late[0], late[-1]), BOOST)
    refit = models.fit_rounds(table, BOOST, run.best).model(run.best)
    table.close()
    counts = search.agg(F.count(F.lit(1)).alias("search_rows")).withColumns({
        "holdout_rows": holdout.agg(F.count(F.lit(1))).scalar(),
        "refit_matches": F.lit(refit.getNumTrees == run.best + 1),
    })
    return plain(counts)


@query("param_search")
def param_search(spark, sf_dir):
    train, _ = split.time_split(staged_features(spark, sf_dir))
    rows = models.assemble(split.with_week_key(train), models.model_columns(train), log=True)
    rows = rows.select("Store", "Date", "Sales", split.WEEK, "features", "label")
    trials = models.param_search(rows, BOOST, DEFAULT_CONFIG.search_trials, DEFAULT_CONFIG.cv_splits)
    return plain(models.trial_table(spark, trials))


_STORED: dict[tuple[str, str], tuple[str, str]] = {}


def _trained(spark, sf_dir):
    """The stored model of this session and table, trained when first asked for, and the rows to score."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        train, test = split.time_split(staged_features(spark, sf_dir))
        path, rows = scratch_path(spark, "model"), scratch_path(spark, "test-rows")
        files.sink_stage(test, rows)
        models.save_model(models.train_boosted(train, test, BOOST).model, path)
        _STORED[key] = path, rows
    path, rows = _STORED[key]
    return models.load_model(spark, path), files.scan_stage(spark, rows)


_TEST_ROWS = ctes(PANEL, _WEEKS, "held as (select keyed.* from keyed, cut where k > pk)")


@query("predict", _TEST_ROWS + f"""select {KEYS}, {r('"Sales"')} as "Sales", {i("1")} as scored from held""")
def predict(spark, sf_dir):
    """Every row of the test weeks has a prediction, and no negative one."""
    model, test = _trained(spark, sf_dir)
    scored = models.predict(model, test).withColumn("scored", F.col("PredictedSales") >= 0)
    return plain(scored.select("Store", "Date", "Sales", "scored"))


@query("predicted_sales")
def predicted_sales(spark, sf_dir):
    model, test = _trained(spark, sf_dir)
    return plain(models.predict(model, test).select("Store", "Date", "Sales", "PredictedSales"))


@query("model_io", _TEST_ROWS + f"""select {i("count(*)")} as rows, {i("0")} as different from held""")
def model_io(spark, sf_dir):
    """A model that was saved and loaded again predicts the same."""
    model, test = _trained(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save_model(model, path)
    loaded = models.load_model(spark, path)
    again = models.predict(loaded, test).select("Store", "Date", F.col("PredictedSales").alias("Loaded"))
    both = models.predict(model, test).select("Store", "Date", "PredictedSales").join(again, ["Store", "Date"])
    return plain(both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("Loaded") != F.col("PredictedSales")).alias("different")
    ))


@query("importance")
def importance(spark, sf_dir):
    return plain(models.importance(spark, _trained(spark, sf_dir)[0]), 6)


@query("top_features")
def top_features(spark, sf_dir):
    return plain(models.top_features(models.importance(spark, _trained(spark, sf_dir)[0])), 6)


@query("importance_total", f"select {i('78')} as features, {r('1')} as total, {i('0')} as negative")
def importance_total(spark, sf_dir):
    values = models.importance(spark, _trained(spark, sf_dir)[0])
    return plain(values.agg(
        F.count(F.lit(1)).alias("features"), F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("negative")
    ))


@query("training_facts", _TEST_ROWS + f"""
select {i("count(*)")} as samples, {r('sum("Sales")', 0)} as actual_total, 1 as beats_mean, 1 as top_is_sorted, 20 as top, 1 as top_is_largest, 1 as shares_add_up,
  {i("(select count(distinct k) from keyed, cut where k <= pk)")} as train_weeks, {i("count(distinct k)")} as test_weeks from held""")
def training_facts(spark, sf_dir):
    """What must hold of the trained model: it scores all rows of the test weeks better than the mean; its importances rank and add up."""
    model, test = _trained(spark, sf_dir)
    train, _ = split.time_split(retail.sales_panel(spark, sf_dir, "nation"))
    scored = models.predict(model, test).select("Store", "Date", F.col("Sales").alias("ActualSales"), "PredictedSales")
    ours = forecast_metrics(scored).first()
    logs = train.agg(F.avg(F.log1p("Sales"))).first()[0]
    level = F.avg((F.log1p("ActualSales") - F.lit(logs)) ** 2)
    better = scored.agg(F.avg((F.log1p("ActualSales") - F.log1p(F.greatest("PredictedSales", F.lit(0.0)))) ** 2) < level).first()[0]
    values = models.importance(spark, model)
    top = models.top_features(values, 20).collect()
    ranked = sorted((row["importance"] for row in values.collect()), reverse=True)
    facts = {
        "samples": ours["Samples"], "beats_mean": bool(better), "top": len(top), "train_weeks": len(split.week_keys(train)),
        "test_weeks": len(split.week_keys(test)), "top_is_sorted": [t["importance"] for t in top] == sorted(t["importance"] for t in top),
        "top_is_largest": sorted(t["importance"] for t in top) == sorted(ranked[:20]), "shares_add_up": abs(sum(ranked) - 1) < 1e-9,
    }
    total = scored.agg(F.round(F.sum("ActualSales"), 0).alias("actual_total"))
    return plain(total.withColumns({k: F.lit(v) for k, v in facts.items()}))


@query("line_of_one_feature", ctes(PANEL) + f"""
select {r('regr_slope("Sales", "Promo")')} as slope, {r('regr_intercept("Sales", "Promo")')} as intercept from panel""")
def line_of_one_feature(spark, sf_dir):
    """The linear model on one feature is the least-squares line."""
    from pyspark.ml.regression import LinearRegression

    rows = models.assemble(retail.sales_panel(spark, sf_dir, "nation"), ["Promo"])
    fitted = LinearRegression(solver="normal").fit(rows.select("features", "label"))
    line = spark.range(1).select(F.lit(float(fitted.coefficients[0])).alias("slope"), F.lit(float(fitted.intercept)).alias("intercept"))
    return plain(line)


@query("model_comparison")
def model_comparison(spark, sf_dir):
    train, test = split.time_split(staged_features(spark, sf_dir))
    base, _ = models.baselines(train, test, FOREST)
    boosted = models.train_boosted(train, test, BOOST).metrics
    return plain(models.model_comparison(base, boosted).select("model", "MAPE", "R2", "MAE", "RMSE", "is_best", "is_worst"))


@query("train_job")
def train_job(spark, sf_dir):
    root = scratch_path(spark, "train_job")
    warehouse = fresh_warehouse(spark, "train_job_tables")
    training.train_job(staged_features(spark, sf_dir), f"{root}/model", f"{root}/reports", warehouse, base=BOOST)
    return plain(warehouse.model_metrics().select("mape", "rmse", "mae", "r2_score", "n_features", "n_train_samples", "n_test_samples", "best_params"))
