from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import evaluation, forecast
from tests.data import panel, rows

DAY = timedelta(days=1)
SCHEME = {"initial": 30 * DAY, "horizon": 10 * DAY, "period": 5 * DAY}
TERMS = forecast.Design(
    changepoints=2, seasonalities=((7.0, 3), (1.0, 2)), extra=(3.5, 1), holidays="federal", regressors=("avg_temp",)
)


def cutoffs(first, last):
    out, cutoff = [], last - SCHEME["horizon"]
    while cutoff >= first + SCHEME["initial"]:
        out.append(cutoff)
        cutoff -= SCHEME["period"]
    return out


def test_folds_match_the_definition(spark):
    df = panel(spark)
    pdf = df.toPandas()
    got = {(r.station, r.fold): r for r in forecast.cv_folds(df, ["station"], **SCHEME).collect()}
    assert len(got) == 2 * 4
    for station, part in pdf.groupby("station"):
        for fold, cutoff in enumerate(cutoffs(part.ds.min(), part.ds.max())):
            r = got[station, fold]
            assert r.cutoff == cutoff
            assert r.train_rows == (part.ds <= cutoff).sum()
            assert r.test_rows == ((part.ds > cutoff) & (part.ds <= cutoff + SCHEME["horizon"])).sum()


def test_too_short_a_history_has_no_fold(spark):
    short = panel(spark, days=39)
    assert forecast.cv_folds(short, ["station"], **SCHEME).count() == 0
    assert forecast.cv_profile(short, **SCHEME).count() == 0
    assert rows(forecast.fit_panel(short, design=TERMS, folds=True, **SCHEME), "station", "fold") == [("A", -1), ("B", -1)]


def test_profile_cv_uses_the_past_only(spark):
    df = panel(spark, days=45)
    pdf = df.toPandas().assign(wd=lambda d: d.ds.dt.weekday, hh=lambda d: d.ds.dt.hour)
    got = forecast.cv_profile(df, **SCHEME).toPandas()
    for (station, fold), part in got.groupby(["station", "fold"]):
        own = pdf[pdf.station == station]
        cutoff = cutoffs(own.ds.min(), own.ds.max())[fold]
        assert part.ds.min() > cutoff and part.ds.max() <= cutoff + SCHEME["horizon"]
        means = own[own.ds <= cutoff].groupby(["wd", "hh"]).y.mean()
        expected = [means[d.weekday(), d.hour] for d in part.ds]
        assert part.yhat.tolist() == pytest.approx(expected)


def test_profile_forecast_of_unseen_slot_is_null(spark):
    df = panel(spark, days=1)
    later = df.select("station", (F.col("ds") + F.expr("INTERVAL 1 DAY")).alias("ds"))
    assert forecast.apply_profile(later, forecast.seasonal_profile(df)).where("yhat is not null").count() == 0


def brute_force(pdf, setting, design, cutoff=None):
    """The same penalised regression from the full design matrix of one station."""
    first, last = pdf.ds.min(), pdf.ds.max()
    # Terms of the ten federal holidays; only the second and third fall into the history.
    holidays = {1: datetime(2022, 1, 17), 2: datetime(2022, 2, 21)}

    def terms(d):
        t = (d.ds - first).dt.total_seconds().to_numpy() / (last - first).total_seconds()
        days = (d.ds - datetime(1970, 1, 1)).dt.total_seconds().to_numpy() / 86400
        bends = [0.8 * (i + 1) / (design.changepoints + 1) for i in range(design.changepoints)]
        trend = [np.ones_like(t), t, *[np.maximum(t - b, 0) for b in bends]]
        season = []
        for period, order in [*design.seasonalities, design.extra]:
            for k in range(1, order + 1):
                season += [np.sin(2 * np.pi * k * days / period), np.cos(2 * np.pi * k * days / period)]
        season += [(d.ds.dt.normalize() == holidays.get(i)).to_numpy().astype(float) for i in range(10)]
        season.append(d.avg_temp.to_numpy())
        return np.stack(trend, 1), np.stack(season, 1), t

    train = pdf if cutoff is None else pdf[pdf.ds <= cutoff]
    y = train.y.to_numpy()
    trend, season, t = terms(train)
    additive = setting["seasonality_mode"] == "additive"
    line = (1.0, 0.0) if additive else np.linalg.lstsq(trend[:, :2], y, rcond=None)[0]
    x = np.hstack([trend, season * (line[0] + line[1] * t)[:, None]])
    loose = np.linalg.solve(x.T @ x + 1e-6 * np.trace(x.T @ x) / x.shape[1] * np.eye(x.shape[1]), x.T @ y)
    noise = np.mean((y - x @ loose) ** 2)
    scale = np.abs(y).max()
    prior = np.array(
        [setting["seasonality_prior_scale"]] * (2 * sum(o for _, o in design.seasonalities))
        + [design.extra_prior] * (2 * design.extra[1])
        + [setting["holidays_prior_scale"]] * 11
    ) * (scale if additive else 1)
    trend_prior = np.array([5 * scale] * 2 + [setting["changepoint_prior_scale"] * scale] * design.changepoints)
    weights = noise / np.concatenate([trend_prior, prior]) ** 2
    weights[0] = 0
    weights[-1] *= train.avg_temp.var(ddof=0)
    beta = np.linalg.solve(x.T @ x + np.diag(weights), x.T @ y)
    all_trend, all_season, all_t = terms(pdf)
    fitted = np.hstack([all_trend, all_season * (line[0] + line[1] * all_t)[:, None]]) @ beta
    return dict(zip(pdf.ds, fitted))


@pytest.mark.parametrize("mode", ["additive", "multiplicative"])
def test_regression_equals_brute_force_on_every_fold(spark, mode):
    df = panel(spark)
    setting = {**forecast.DEFAULT_SETTING, "seasonality_mode": mode, "seasonality_prior_scale": 0.5}
    models = forecast.fit_panel(df, grid=[setting], design=TERMS, folds=True, **SCHEME)
    final = models.where("fold = -1").drop("fold", "train_rows")
    fitted = forecast.predict(df, final, ["station"], TERMS).toPandas()
    held_out = forecast.cv_predict(df, models, design=TERMS, **SCHEME).toPandas()
    pdf = df.toPandas()
    for station, part in pdf.groupby("station"):
        expected = brute_force(part, setting, TERMS)
        own = fitted[fitted.station == station]
        assert own.yhat.tolist() == pytest.approx([expected[d] for d in own.ds], rel=1e-4, abs=1e-4)
        for fold, cutoff in enumerate(cutoffs(part.ds.min(), part.ds.max())):
            own = held_out[(held_out.station == station) & (held_out.fold == fold)]
            expected = brute_force(part, setting, TERMS, cutoff)
            assert len(own) == 240
            assert own.yhat.tolist() == pytest.approx([expected[d] for d in own.ds], rel=1e-3, abs=1e-3)


def test_regression_recovers_the_signal_and_covers_it(spark):
    df = panel(spark)
    good = {**forecast.DEFAULT_SETTING, "seasonality_mode": "additive"}
    bad = {**good, "seasonality_prior_scale": 1e-6, "holidays_prior_scale": 1e-6}
    models = forecast.fit_panel(df, grid=[bad, good], design=TERMS, folds=True, **SCHEME)
    held_out = forecast.cv_predict(df, models, design=TERMS, **SCHEME)
    scores = evaluation.forecast_metrics(held_out, ["station", "setting_id"])
    best = evaluation.best_params(scores, ["setting_id"], ["station"])
    assert rows(best, "station", "setting_id") == [("A", 1), ("B", 1)]
    assert all(r.mae < 1.0 for r in best.collect())


def test_forecast_covers_history_and_future(spark):
    df = panel(spark, days=20)
    models = forecast.fit_panel(df, design=TERMS, **SCHEME)
    out = forecast.forecast(df, models, design=TERMS, hours=24)
    assert out.where("is_future").count() == 48 and out.count() == df.count() + 48
    assert out.where("yhat is null").count() == 0
    assert out.where("yhat_lower < yhat and yhat < yhat_upper").count() == out.count()


def test_default_design_and_grid_corner_settings(spark):
    df = panel(spark, days=50)
    design = forecast.Design(regressors=("avg_temp",))
    corners = [forecast.param_grid()[i] for i in (0, -1)]
    models = forecast.fit_panel(df, grid=corners, design=design, **SCHEME)
    final = models.where("fold = -1").drop("fold", "train_rows")
    fitted = forecast.predict(df, final, ["station"], design)
    assert fitted.where("yhat is null or isnan(yhat)").count() == 0
    scores = evaluation.forecast_metrics(fitted, ["station", "setting_id"]).collect()
    assert len(scores) == 4 and all(r.mae < 3 for r in scores)
    assert min(r.mae for r in scores) < 0.5


def test_grid(spark):
    grid = forecast.param_grid()
    assert len(grid) == 128 and len({tuple(s.items()) for s in grid}) == 128
    assert forecast.with_settings(spark.range(3), forecast.GRID).distinct().count() == 3 * 128


def test_metrics(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0, 0.0, 3.0), ("a", 4.0, 2.0, 3.0, 5.0), ("a", 0.0, 1.0, -1.0, 1.0), ("b", 0.0, 3.0, 1.0, 2.0)],
        "g string, y double, yhat double, yhat_lower double, yhat_upper double",
    )
    a, b = evaluation.forecast_metrics(df, ["g"]).orderBy("g").collect()
    assert (a.mse, a.mae, a.coverage) == pytest.approx((2.0, 4 / 3, 1.0))
    assert a.mdape == pytest.approx(0.75)
    assert b.mdape is None and b.coverage == 0.0
    assert rows(evaluation.forecast_metrics(df, ["g"], ["mae"]), "g", "mae") == [("a", a.mae), ("b", b.mae)]
    overall = evaluation.forecast_metrics(df).first()
    assert overall.mae == pytest.approx(7 / 4) and overall.rmse == pytest.approx(overall.mse**0.5)


def test_residual_shape(spark):
    x = np.arange(20.0)
    df = spark.createDataFrame([("s", float(v), float(2 - 0.5 * v)) for v in x], "station string, yhat double, residual double")
    line = evaluation.residual_trend(df, ["station"]).first()
    assert (line.slope, line.intercept, line.r2, line.pairs) == pytest.approx((-0.5, 2.0, 1.0, 20))
    spread = evaluation.residual_distribution(df).first()
    assert [spread.p0, spread.p50, spread.p100] == pytest.approx(list(np.percentile(2 - 0.5 * x, [0, 50, 100])))
    bins = evaluation.residual_histogram(df, -4, 2, 3)
    assert bins.agg(F.sum("count")).first()[0] == 20
    history = df.select("station", F.timestamp_seconds(F.col("yhat").cast("long")).alias("ds"), F.lit(1.0).alias("y"))
    joined = evaluation.residuals(history.select("station", "ds", F.lit(3.0).alias("yhat")), history)
    assert rows(joined.select("residual").distinct()) == [(2.0,)]
