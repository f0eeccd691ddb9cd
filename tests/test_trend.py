"""Trends: sparse changes, changepoints in each fold's own history, and intervals that widen."""

from dataclasses import replace
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import evaluation, forecast, trend
from tests.data import panel

DAY = timedelta(days=1)
SCHEME = {"initial": 30 * DAY, "horizon": 10 * DAY, "period": 5 * DAY}
TERMS = forecast.Design(
    changepoints=5, seasonalities=((7.0, 3), (1.0, 2)), extra=(3.5, 1), holidays="federal", regressors=("avg_temp",)
)
SPARSE = replace(TERMS, trend_prior="laplace")
GRID = forecast.param_grid(
    {
        "changepoint_prior_scale": [0.001, 0.05, 0.5],
        "seasonality_prior_scale": [0.1, 10.0],
        "holidays_prior_scale": [1.0],
        "seasonality_mode": ["additive", "multiplicative"],
    }
)


def wide(frame, design):
    """Trend and seasonal terms of every row, by the library's own expressions."""
    return forecast.seasonal_features(frame, design).toPandas().sort_values(["station", "ds"])


def trend_terms(seconds, model):
    t = (seconds - model["_first"]) / max(model["_last"] - model["_first"], 1)
    return np.column_stack([np.ones_like(t), t, *[np.maximum(t - k, 0) for k in model["knots"]]])


def gradient(pdf, model, design):
    """Slope of the penalised loss in every coefficient, apart from the absolute penalty, whose weight comes second."""
    y, season = pdf.y.to_numpy(float), np.stack(pdf.season_x.to_list())
    seconds = pdf.ds.astype("datetime64[s]").astype("int64").to_numpy()
    head = trend_terms(seconds, model)
    lift = model["lift_base"] + model["lift_slope"] * head[:, 1]
    x = np.hstack([head, season * lift[:, None]])
    loose = x.T @ x + 1.001e-6 * np.trace(x.T @ x) / x.shape[1] * np.eye(x.shape[1])
    noise = max(np.mean((y - x @ np.linalg.solve(loose, x.T @ y)) ** 2), 1e-12)
    scale = np.abs(y).max()
    groups = design.season_groups()
    prior = {"season": model["seasonality_prior_scale"], "extra": design.extra_prior}
    prior |= {"holiday": model["holidays_prior_scale"], "regressor": model["holidays_prior_scale"]}
    season_prior = np.array([prior[g] for g in groups]) * (scale if model["seasonality_mode"] == "additive" else 1.0)
    weights = noise / np.concatenate([np.full(head.shape[1], 5 * scale), season_prior]) ** 2
    weights[0] = 0.0
    weights[2 : head.shape[1]] = 0.0
    weights[-1] *= season[:, -1].var()
    weights += 1e-9 * np.trace(x.T @ x) / x.shape[1]
    coef = np.concatenate([model["trend_coef"], model["season_coef"]])
    slope = x.T @ (x @ coef - y) + weights * coef
    return slope, noise / (model["changepoint_prior_scale"] * scale), np.abs(x).T @ np.abs(y)


@pytest.mark.parametrize("own", [False, True])
def test_sparse_fit_meets_the_optimality_conditions_on_every_fold(spark, own):
    design = replace(SPARSE, own_trend=own)
    frame = panel(spark)
    models = forecast.fit_panel(frame, grid=GRID, design=design, folds=True, **SCHEME).collect()
    assert len(models) == 2 * 5 * len(GRID)
    terms = wide(frame, design)
    zeros = 0
    for m in models:
        mine = terms[terms.station == m.station]
        cutoff = mine.ds.max() - SCHEME["horizon"] - m.fold * SCHEME["period"] if m.fold >= 0 else mine.ds.max()
        slope, by, size = gradient(mine[mine.ds <= cutoff], m.asDict(), design)
        change = np.zeros(len(slope), bool)
        change[2 : 2 + design.changepoints] = True
        deltas = np.array(m.trend_coef[2:])
        tight = 1e-6 * size.max()
        assert np.abs(slope[~change]).max() < tight
        assert (np.abs(slope[change]) <= by + tight).all()
        moving = deltas != 0
        assert np.abs(slope[change][moving] + by * np.sign(deltas[moving])).max(initial=0) < tight
        zeros += int((~moving).sum())
    assert zeros > len(models)


def test_lasso_without_penalty_is_least_squares_and_with_a_large_one_nothing():
    rng = np.random.default_rng(2)
    t = np.linspace(0, 1, 400)
    x = np.column_stack([np.maximum(t - k / 30, 0) for k in range(25)])
    y = 3 * x[:, 5] - 7 * x[:, 14] + rng.normal(0, 0.01, 400)
    gram, side = x.T @ x, x.T @ y
    assert trend.lasso(gram, side, 1e9).tolist() == [0.0] * 25
    found = trend.lasso(gram, side, 0.02)
    slack = side - gram @ found
    assert (np.abs(slack) <= 0.02 * (1 + 1e-6)).all() and 0 < (found != 0).sum() < 12
    assert np.abs(slack[found != 0] - 0.02 * np.sign(found[found != 0])).max() < 1e-6
    assert len(trend.lasso(np.zeros((0, 0)), np.zeros(0), 1.0)) == 0


@pytest.mark.parametrize("design", [replace(TERMS, own_trend=True), replace(SPARSE, own_trend=True)])
def test_own_trend_equals_a_fit_of_each_fold_alone(spark, design):
    frame = panel(spark)
    grid = GRID[:2]
    folds = forecast.fit_panel(frame, grid=grid, design=design, folds=True, **SCHEME).where("fold >= 0").collect()
    cutoffs = {(r.station, r.fold): r.cutoff for r in forecast.cv_folds(frame, ["station"], **SCHEME).collect()}
    assert len(folds) == len(cutoffs) * len(grid)
    for fold in {f for _, f in cutoffs}:
        early = frame.where(F.col("ds") <= F.lit(cutoffs["A", fold])).where("station = 'A'")
        alone = {r.setting_id: r for r in forecast.fit_panel(early, grid=grid, design=design, **SCHEME).collect()}
        for m in folds:
            if (m.station, m.fold) == ("A", fold):
                want = alone[m.setting_id]
                assert (m._first, m._last, m.train_rows) == (want._first, want._last, want.train_rows)
                assert m.knots == want.knots and 0 < m.knots[0] and m.knots[-1] < 0.9
                assert m.trend_coef == pytest.approx(want.trend_coef, rel=1e-5, abs=1e-5)
                assert m.season_coef == pytest.approx(want.season_coef, rel=1e-5, abs=1e-5)
                assert m.sigma == pytest.approx(want.sigma)


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_own_trend_equals_the_dense_system(spark, mode):
    """The sums at changepoints give the same system as the design matrix written out."""
    rng = np.random.default_rng(5)
    seconds = 1640995200 + 3600 * np.sort(rng.choice(2000, 700, replace=False))
    season, y = rng.normal(size=(700, 4)), rng.normal(size=700) + np.linspace(0, 3, 700)
    sums = trend.OwnSums(4, 6, int(seconds[0]))
    for part in np.array_split(np.arange(700), 9):
        block = trend.own_block_sums(y[part], season[part], seconds[part], int(seconds[0]))
        sums.add(type("Block", (), block))
    head = trend_terms(seconds, {"_first": int(seconds[0]), "_last": int(seconds[-1]), "knots": sums.knots()})
    left, right, (a, b) = sums.system(mode, 8)
    x = np.hstack([head, season * (a + b * head[:, 1:2])])
    assert left == pytest.approx(x.T @ x, rel=1e-8, abs=1e-7)
    assert right == pytest.approx(x.T @ y, rel=1e-8, abs=1e-7)
    assert sums.variances()[8:] == pytest.approx(season.var(axis=0))


def test_the_history_is_read_as_often_for_a_grid_as_for_one_setting(spark, tmp_path):
    panel(spark).write.parquet(str(tmp_path / "panel"))
    frame = spark.read.parquet(str(tmp_path / "panel"))

    def scans(**options):
        models = forecast.fit_panel(frame, design=replace(SPARSE, own_trend=True), **options, **SCHEME)
        return models._jdf.queryExecution().optimizedPlan().toString().count("parquet")

    assert scans(grid=GRID, folds=True) == scans() == 2


def walk(spark, stations=40, days=60):
    """Stations whose slope changes at random, as often as the changepoints lie apart, plus noise."""
    rng = np.random.default_rng(8)
    rows, first = [], datetime(2022, 1, 1)
    for s in range(stations):
        level, slope = 0.0, 0.0
        for h in range(days * 24):
            if rng.random() < 1 / 96:
                slope += rng.laplace(0, 0.01)
            level += slope
            rows.append((f"s{s}", first + timedelta(hours=h), float(level + rng.normal(0, 0.3))))
    return spark.createDataFrame(rows, "station string, ds timestamp, y double").repartition(8)


def test_intervals_widen_and_cover_held_out_rows(spark):
    frame = walk(spark)
    design = forecast.Design(changepoints=25, seasonalities=(), extra=None, holidays=None, regressors=(), trend_prior="laplace", own_trend=True)
    setting = {**forecast.DEFAULT_SETTING, "seasonality_mode": "additive", "changepoint_prior_scale": 0.5}
    models = forecast.fit_panel(frame, grid=[setting], design=design, folds=True, **SCHEME).cache()
    held_out = forecast.cv_predict(frame, models, design=design, **SCHEME)
    cutoffs = forecast.cv_folds(frame, ["station"], **SCHEME).select("station", "fold", "cutoff")
    days = {r.horizon_days: r for r in evaluation.coverage_by_horizon(held_out.join(cutoffs, ["station", "fold"])).collect()}
    assert sorted(days) == list(range(1, 11))
    widths = [days[d].width for d in range(1, 11)]
    assert widths == sorted(widths) and widths[-1] > 2 * widths[0]
    # below 80 %: slopes also change in the last fifth of a history, where no changepoint lies
    assert all(0.4 < days[d].coverage < 0.9 for d in days)
    assert days[10].coverage > days[3].coverage
    flat = forecast.cv_predict(frame, models.withColumn("drift", F.lit(0.0)), design=design, **SCHEME)
    plain = {r.horizon_days: r for r in evaluation.coverage_by_horizon(flat.join(cutoffs, ["station", "fold"])).collect()}
    assert plain[10].width == pytest.approx(plain[1].width) and plain[10].coverage < days[10].coverage / 2


def test_drift_is_the_variance_of_simulated_changes():
    rng = np.random.default_rng(1)
    changes, t, rate = np.array([0.5, -1.5, 0.0, 2.0]), 1.4, 4
    total = np.zeros(40_000)
    for i in range(len(total)):
        at = rng.uniform(1, t, rng.poisson(rate * (t - 1)))
        total[i] = (rng.laplace(0, np.abs(changes).mean(), len(at)) * (t - at)).sum()
    assert total.var() == pytest.approx(trend.drift(changes) * (t - 1) ** 3, rel=0.05)
    assert trend.drift(np.zeros(0)) == 0.0


def test_nothing_missing_and_tied_rows(spark):
    design = replace(SPARSE, own_trend=True, changepoints=3)
    none = panel(spark).limit(0)
    assert forecast.fit_panel(none, design=design, folds=True, **SCHEME).count() == 0
    frame = panel(spark, days=45)
    gaps = frame.withColumn("y", F.when(F.hour("ds") != 3, F.col("y"))).unionByName(frame.where("false"))
    part = frame.where(F.hour("ds") != 3)
    pair = [forecast.fit_panel(f, design=design, folds=True, **SCHEME).orderBy("station", "fold").collect() for f in (gaps, part)]
    for a, b in zip(*pair, strict=True):
        assert a.trend_coef == pytest.approx(b.trend_coef) and a.train_rows == b.train_rows
    one = frame.where(F.col("ds") == F.lit(datetime(2022, 1, 3)))
    lone = forecast.fit_panel(one.unionByName(one), design=design, **SCHEME).collect()
    assert all(m._last == m._first and np.isfinite(m.trend_coef).all() and m.train_rows == 2 for m in lone) and lone


def test_an_unknown_prior_is_refused():
    with pytest.raises(ValueError, match="cauchy"):
        forecast.Design(trend_prior="cauchy")


@pytest.mark.parametrize("own", [False, True])
def test_scores_of_all_settings_are_those_of_each(spark, own):
    design = replace(SPARSE, own_trend=own)
    frame = panel(spark).withColumn("y", F.when(F.hour("ds") != 5, F.col("y")))
    models = forecast.fit_panel(frame, grid=GRID, design=design, folds=True, **SCHEME).cache()
    columns = ["station", "setting_id", "seasonality_mode", "fold", "ds", "y", "yhat", "yhat_lower", "yhat_upper"]
    one = forecast.cv_predict(frame, models, design=design, **SCHEME).select(columns).orderBy(columns[:5]).collect()
    many = forecast.score_settings(frame, models, design=design, **SCHEME).select(columns).orderBy(columns[:5]).collect()
    assert len(one) == len(many) > 2000
    for a, b in zip(one[::37], many[::37], strict=True):
        assert a[:6] == b[:6] and list(b[6:]) == pytest.approx(list(a[6:]), rel=1e-9, abs=1e-9)
    assert forecast.score_settings(frame.limit(0), models, design=design, **SCHEME).count() == 0
    assert forecast.score_settings(frame, models.limit(0), design=design, **SCHEME).count() == 0
