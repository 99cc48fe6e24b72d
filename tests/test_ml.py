from __future__ import annotations

import datetime as dt
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.config import DEFAULT_CONFIG
from daybook.ml import boosting, models, split, training
from daybook.plans import jobs
from daybook.plans.features import build_features, feature_names
from daybook.sources.tables import Warehouse

SCHEMA = (
    "Store int, Date date, Sales double, Customers double, Open int, DayOfWeek int, Promo int, StateHoliday string, "
    "SchoolHoliday int, StoreType string, Assortment string, CompetitionDistance double, CompetitionOpenSinceMonth double, "
    "CompetitionOpenSinceYear double, Promo2 int, Promo2SinceWeek double, Promo2SinceYear double, PromoInterval string"
)


@pytest.fixture(scope="module")
def merged(spark):
    rng = np.random.default_rng(0)
    rows = []
    for store in range(1, 7):
        for n in range(200):
            day = dt.date(2023, 1, 2) + dt.timedelta(days=n)
            promo = int(n % 14 < 5)
            sales = (1000 + 300 * store) * (1.3 if promo else 1.0) * (0.8 + 0.05 * day.isoweekday()) + rng.normal(0, 30)
            rows.append((store, day, float(sales), 10.0, 1, day.isoweekday(), promo, "0", 0, "abcd"[store % 4], "abc"[store % 3],
                         500.0 * store, 3.0, 2010.0, 0, None, None, None))
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def features(merged):
    return build_features(merged).cache()


BOOST = models.BoostSettings(max_iter=15, depth=4, bins=32, step=0.3, min_rows=5)


def test_split_keeps_weeks_whole(features):
    train, test = split.time_split(features, 0.8)
    weeks = split.week_keys(features)
    assert len(split.week_keys(train)) == int(len(weeks) * 0.8) + 1
    assert max(split.week_keys(train)) < min(split.week_keys(test))
    assert train.count() + test.count() == features.count()
    assert train.select("Store").distinct().count() == test.select("Store").distinct().count() == 6
    assert split.label_split(features, 0.8).where("IsTrain = 1").count() == train.count()


def test_split_errors(features):
    for ratio in (0.0, 1.0, -1.0):
        with pytest.raises(ValueError):
            split.time_split(features, ratio)
    with pytest.raises(ValueError):
        split.time_split(features.where("Week = 2"), 0.8)
    with pytest.raises(ValueError):
        split.expanding_folds([1, 2], 3)


def test_expanding_folds():
    assert split.expanding_folds(list(range(10)), 3) == [
        ([0, 1, 2, 3], [4, 5]), ([0, 1, 2, 3, 4, 5], [6, 7]), ([0, 1, 2, 3, 4, 5, 6, 7], [8, 9])
    ]


def test_models_beat_the_mean_and_survive_saving(spark, features, root):
    train, test = split.time_split(features)
    base, _ = models.baselines(train, test, models.ForestSettings(trees=10, depth=5))
    w = Warehouse(spark, f"{root}/tables")
    result = training.train_job(features, f"{root}/model", f"{root}/reports", w, settings=BOOST)
    ranked = models.model_comparison(base, result.metrics).collect()
    assert [r.model for r in ranked][-1] == "MeanBaseline" and len(ranked) == 4
    assert result.features == feature_names()
    loaded = models.load_model(spark, f"{root}/model")
    assert models.feature_list(loaded) == feature_names()
    a = models.predict(loaded, test).agg(F.sum("PredictedSales")).first()[0]
    assert a == pytest.approx(models.predict(result.model, test).agg(F.sum("PredictedSales")).first()[0])
    top = models.top_features(models.importance(spark, loaded), 5).collect()
    assert len(top) == 5 and top[-1].normalized == 1.0 and top[0].normalized == 0.0
    assert w.model_metrics().first().n_features == 78
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, f"{root}/none")


def test_a_failing_model_becomes_an_error_row(features):
    train, test = split.time_split(features)
    table, _ = models.baselines(train, test, models.ForestSettings(trees=10, depth=31))
    rows = {r.model: r for r in table.collect()}
    assert rows["RandomForest"].error and rows["MeanBaseline"].error is None and rows["LinearRegression"].MAPE < rows["MeanBaseline"].MAPE


def test_search_is_seeded(features):
    train, _ = split.time_split(features)
    rows = models.assemble(split.with_week_key(train), models.model_columns(train), log=True)
    rows = rows.select("Store", "Date", "Sales", split.WEEK, "features", "label")
    base = models.BoostSettings(max_iter=3)
    runs = [models.param_search(rows, base, trials=2, splits=2, parallel=2) for _ in range(2)]
    assert [t.settings for t in runs[0]] == [t.settings for t in runs[1]]
    assert [t.score for t in runs[0]] == pytest.approx([t.score for t in runs[1]])
    assert runs[0][0].score <= runs[0][1].score


@pytest.fixture(scope="module")
def weekly(features):
    train, _ = split.time_split(features)
    rows = models.assemble(split.with_week_key(train), models.model_columns(train), log=True)
    rows = rows.select("Store", "Date", "Sales", split.WEEK, "features", "label").cache()
    weeks = split.week_keys(rows)
    return rows, (weeks[0], weeks[-6]), (weeks[-5], weeks[-1])


SMALL = models.BoostSettings(max_iter=300, patience=12, depth=4, step=0.2, min_rows=10, bins=40)


def shape(run):
    return [(t.feature.tolist(), t.cut.tolist(), t.value.round(9).tolist()) for t in run.trees]


def test_boosting_continues_and_stops_by_patience(weekly):
    rows, early, late = weekly
    table = boosting.bin_rows(rows)
    assert table.count == 1
    whole = boosting.fit_with_stop(table, early, late, SMALL)
    assert whole.finished and whole.rounds == whole.best + SMALL.patience and len(whole.losses) == whole.rounds
    pieces = boosting.Boosting(table, SMALL, early, late)
    while not pieces.finished:
        pieces.advance(7)
    assert shape(pieces) == shape(whole) and pieces.losses == pytest.approx(whole.losses)
    other = boosting.fit_with_stop(table, early, late, replace(SMALL, seed=7))
    assert shape(other) != shape(whole)
    start = sum(whole.losses[:1])
    assert whole.losses[whole.best - 1] < 0.5 * start


def test_many_blocks_give_the_trees_of_one(weekly, monkeypatch):
    rows, early, late = weekly
    monkeypatch.setattr(boosting, "STAGE_ROUNDS", 3)
    one, many = boosting.bin_rows(rows), boosting.bin_rows(rows, block_rows=200)
    assert many.count > 3
    runs = [boosting.Boosting(t, SMALL, early, late) for t in (one, many)]
    for run in runs:
        run.advance(8)
    assert shape(runs[0]) == shape(runs[1]) and runs[0].losses == pytest.approx(runs[1].losses)
    assert runs[1].staged == 6 and runs[1].path is not None
    terms = lambda label, score: abs(label - score)
    assert runs[0].error(late, terms, 5) == pytest.approx(runs[1].error(late, terms, 5))
    for run in runs:
        run.close()


def test_stored_model_scores_like_the_blocks(weekly, root):
    rows, early, late = weekly
    run = boosting.fit_with_stop(boosting.bin_rows(rows), early, late, SMALL)
    model = run.model()
    assert model.getNumTrees == run.best + 1
    model.save(f"{root}/m")
    held = rows.where(F.col(split.WEEK).between(*late))
    loss = type(model).load(f"{root}/m").transform(held).agg(F.avg((F.col("label") - F.col("prediction")) ** 2)).first()[0]
    assert loss == pytest.approx(run.losses[run.best - 1])
    weights = model.featureImportances.toArray()
    assert weights.sum() == pytest.approx(1.0) and (weights >= 0).all()


def test_a_split_is_the_best_of_all_thresholds():
    rng = np.random.default_rng(1)
    x, rest = rng.integers(0, 9, (3, 400)).astype(np.uint8), rng.normal(size=400)
    rest[x[1] > 4] += 2
    offsets, features = np.array([0, 9, 18, 27]), np.array([0, 1, 2])
    settings = replace(SMALL, min_rows=20)
    sums = boosting.node_sums(x, rest, np.zeros(400, int), np.ones(400, bool), np.array([0]), features, offsets)
    found = boosting.best_splits(sums, settings, features, offsets)[0]
    loss = lambda r: ((r - r.mean()) ** 2).sum()
    plain = max((loss(rest) - loss(rest[x[f] <= c]) - loss(rest[x[f] > c]), f, c) for f in range(3) for c in range(8) if 20 <= (x[f] <= c).sum() <= 380)
    assert found[0] == pytest.approx(plain[0]) and found[1:3] == plain[1:]


def test_race_drops_trials_between_rungs(weekly):
    rows, *_ = weekly
    trials = models.param_search(rows, replace(SMALL, patience=10, max_iter=60), trials=6, splits=2, rung=10)
    finished, dropped = [t for t in trials if not t.pruned], [t for t in trials if t.pruned]
    assert trials == finished + dropped and finished and dropped
    assert finished == sorted(finished, key=lambda t: t.score)
    for t in finished:
        assert all(r == 60 or r - best == 10 for r, best in zip(t.rounds, t.iterations))
    assert max(sum(t.rounds) for t in dropped) <= max(sum(t.rounds) for t in finished)
    table = models.trial_table(rows.sparkSession, trials)
    assert table.where("pruned").count() == len(dropped) and table.count() == 6


def test_training_searches_when_no_settings_are_given(features):
    train, test = split.time_split(features)
    config = replace(DEFAULT_CONFIG, search_trials=2, cv_splits=2)
    result = models.train_boosted(train, test, config=config, base=models.BoostSettings(max_iter=3))
    assert result.iterations <= 3 and result.settings.min_rows >= 100
    assert result.predictions.count() == result.test_rows


def test_predict_job(spark, merged, root):
    w = Warehouse(spark, root)
    raw = merged.withColumn("Date", F.col("Date").cast("string")).withColumn("seq", F.lit(1))
    past, today = raw.where("Date < '2023-07-20'"), raw.where("Date = '2023-07-20'")
    score = lambda df: df.withColumn("PredictedSales", F.col("SalesLag_7"))
    jobs.predict_job(past, ["seq"], w, score, run_id="run_past")
    run_id, rows = jobs.predict_job(today, ["seq"], w, score)
    week_ago = {r.Store: r.Sales for r in merged.where("Date = date '2023-07-13'").collect()}
    assert {r.Store: r.PredictedSales for r in rows.collect()} == week_ago  # lags reach into the stored history
    assert jobs.validate_job(rows).first().all_passed
    assert run_id.startswith("run_") and w.predictions().select("run_id").distinct().count() == 2


def test_step_log(spark, root):
    log = jobs.StepLog(Warehouse(spark, root))
    log.run("a", lambda: {"records_processed": 3})
    with pytest.raises(RuntimeError):
        log.run("b", lambda: (_ for _ in ()).throw(RuntimeError("no")))
    rows = {r.dag_name: r for r in log.warehouse.pipeline_runs().collect()}
    assert (rows["a"].status, rows["a"].records_processed, rows["b"].status, rows["b"].error_message) == ("success", 3, "failed", "no")


def test_registered_entries_train_with_the_default_settings(monkeypatch):
    from types import SimpleNamespace

    from daybook.plans.catalog import modelling

    used = []

    def record(*args, **named):
        used.extend(a for a in (*args, *named.values()) if isinstance(a, models.BoostSettings))
        raise StopIteration

    monkeypatch.setattr(modelling, "staged_features", lambda *_: None)
    monkeypatch.setattr(modelling, "scratch_path", lambda *_: "")
    monkeypatch.setattr(modelling, "fresh_warehouse", lambda *_: ("", None))
    monkeypatch.setattr(modelling.files, "sink_stage", lambda *_: None)
    rows = SimpleNamespace(select=lambda *_: None)
    monkeypatch.setattr(modelling.split, "time_split", lambda *_: (None, None))
    monkeypatch.setattr(modelling.split, "holdout_split", lambda *_: (None, None))
    monkeypatch.setattr(modelling.split, "with_week_key", lambda *_: None)
    monkeypatch.setattr(modelling.split, "week_keys", lambda *_: [0])
    for name, fake in (("bin_rows", lambda *_: None), ("assemble", lambda *_, **__: rows), ("model_columns", lambda *_: []), ("baselines", lambda *_: (None, None))):
        monkeypatch.setattr(models, name, fake)
    for name in ("train_boosted", "fit_with_stop", "param_search"):
        monkeypatch.setattr(models, name, record)
    monkeypatch.setattr(modelling.training, "train_job", record)
    context = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none"))
    entries = (modelling.boosted_trees, modelling.nested_holdout, modelling.param_search, modelling.predict, modelling.model_comparison, modelling.train_job)
    for entry in entries:
        with pytest.raises(StopIteration):
            entry(context, "none")
    assert used == [models.BoostSettings()] * len(entries)
