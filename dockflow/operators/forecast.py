"""Forecasting net change for a whole panel of stations.

Two forecasters share one evaluation scheme. The seasonal profile is the mean by weekday and hour. The regression has
trend, seasonal, holiday and weather terms with a ridge penalty per group of terms.

Neither is fitted by handing a station's history to one task for each fold and setting. Rolling-origin folds nest, so
sums over time blocks are formed once and added up from the oldest block on; every fold, and every penalty setting,
is solved from those sums. The history is read once however many folds and settings there are.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import timedelta

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.calendar import RULES, holiday_flags
from dockflow.functions.timeparts import weekday_name
from dockflow.operators import trend as bent
from dockflow.operators.series import forward_fill, future_frame
from dockflow.spec import REGRESSORS

# Evaluation scheme and the settings searched.
INITIAL = timedelta(days=420)
HORIZON = timedelta(days=30)
GRID = {
    "changepoint_prior_scale": [0.001, 0.01, 0.1, 0.5],
    "seasonality_prior_scale": [0.01, 0.1, 1.0, 10.0],
    "holidays_prior_scale": [0.01, 0.1, 1.0, 10.0],
    "seasonality_mode": ["additive", "multiplicative"],
}
DEFAULT_SETTING = {
    "changepoint_prior_scale": 0.05,
    "seasonality_prior_scale": 10.0,
    "holidays_prior_scale": 10.0,
    "seasonality_mode": "multiplicative",
}
SETTING_COLUMNS = list(GRID)
HALF_WIDTH = 1.2815515655446004  # of an 80 % normal interval, in standard deviations
ALL_HISTORY = -1


@dataclass(frozen=True)
class Design:
    """Terms of the regression.

    A seasonality is (period in days, number of sine and cosine pairs). ``holidays`` names a rule set, one term per
    holiday; days that follow no rule can be flagged on the frame and named among the regressors.

    ``trend_prior`` is ``"normal"`` or ``"laplace"``: the latter makes most trend changes exactly 0. With ``own_trend``
    the trend of a fold runs over that fold's history and bends there, at multiples of ``knot_grain`` seconds, as a fit
    of that history alone would; without it all folds share the trend time of the whole history.
    """

    changepoints: int = 25
    seasonalities: tuple[tuple[float, int], ...] = ((365.25, 10), (7.0, 3), (1.0, 4))
    extra: tuple[float, int] | None = (24.0, 15)
    extra_prior: float = 0.1
    holidays: str | None = "extended"
    regressors: tuple[str, ...] = tuple(REGRESSORS)
    trend_prior: str = "normal"
    own_trend: bool = False
    knot_grain: int = bent.DAY

    def __post_init__(self):
        if self.trend_prior not in ("normal", "laplace"):
            raise ValueError(f"a trend prior is normal or laplace, not {self.trend_prior!r}")

    def bends(self) -> list[float]:
        """Changepoints spread over the first four fifths of trend time."""
        return [0.8 * (i + 1) / (self.changepoints + 1) for i in range(self.changepoints)]

    @property
    def trend_width(self) -> int:
        return 2 + self.changepoints

    def season_groups(self) -> list[str]:
        """The penalty group of each seasonal term, in column order."""
        names = ["season"] * sum(2 * order for _, order in self.seasonalities)
        names += ["extra"] * (2 * self.extra[1] if self.extra else 0)
        names += ["holiday"] * (len(RULES[self.holidays]) if self.holidays else 0)
        return names + ["regressor"] * len(self.regressors)


#: All terms, sparse trend changes, and changepoints in every fold's own history: what training uses.
FULL_DESIGN = Design(trend_prior="laplace", own_trend=True)


# -- folds --------------------------------------------------------------------------------------------------------


def _epoch(ts: str | Column) -> Column:
    return F.unix_timestamp(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def _seconds(span: timedelta) -> int:
    return int(span.total_seconds())


def series_spans(
    frame: DataFrame, by: Sequence[str], ts: str, initial: timedelta, horizon: timedelta, period: timedelta
) -> DataFrame:
    """First and last time of each series in epoch seconds, and how many cutoffs fit.

    Cutoffs step back by ``period`` from one horizon before the end while ``initial`` lies before them.
    """
    span = frame.groupBy(*by).agg(F.min(_epoch(ts)).alias("_first"), F.max(_epoch(ts)).alias("_last"))
    room = F.col("_last") - F.col("_first") - _seconds(horizon) - _seconds(initial)
    folds = F.greatest(F.floor(room / _seconds(period)) + 1, F.lit(0)).cast("int")
    return span.withColumn("_folds", folds)


def with_folds(
    frame: DataFrame,
    by: Sequence[str],
    ts: str = "ds",
    initial: timedelta = INITIAL,
    horizon: timedelta = HORIZON,
    period: timedelta | None = None,
) -> DataFrame:
    """Place every row in the evaluation scheme by arithmetic alone.

    Fold 0 has the latest cutoff. A row trains fold k when ``_block >= k`` and is held out for the folds in
    ``_tests``, at most ``ceil(horizon / period)`` of them.
    """
    period = period or horizon / 2
    step = _seconds(period)
    placed = frame.join(series_spans(frame, by, ts, initial, horizon, period), list(by))
    age = F.col("_last") - _epoch(ts)
    block = F.floor((age - _seconds(horizon)) / step).cast("int")
    newest = F.greatest(F.col("_block") + 1, F.lit(0))
    oldest = F.least(F.floor(age / step).cast("int"), F.col("_folds") - 1)
    nothing = F.array().cast("array<int>")
    return placed.withColumn("_block", block).withColumn(
        "_tests", F.when(newest <= oldest, F.sequence(newest, oldest)).otherwise(nothing)
    )


def _fold_cutoff(horizon: timedelta, period: timedelta) -> Column:
    return F.timestamp_seconds(F.col("_last") - _seconds(horizon) - F.col("fold") * _seconds(period))


def _running_folds(blocks: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Training sums of every fold, from sums per block (``_block``, ``_folds``).

    Sums run from the oldest block on. A block's running sum is that of all folds down to the next newer block of the
    same keys, so each fold gets one row, and blocks are never repeated for the folds they train.
    """
    older = W.partitionBy(*keys).orderBy(F.col("_block").desc())
    upto = older.rowsBetween(W.unboundedPreceding, 0)
    run = blocks.where((F.col("_block") >= 0) & (F.col("_folds") > 0)).withColumns(
        {**{c: F.sum(c).over(upto) for c in sums}, "_newer": F.coalesce(F.lead("_block").over(older), F.lit(-1))}
    )
    oldest = F.least(F.col("_block"), F.col("_folds") - 1)
    return run.where(F.col("_newer") < oldest).withColumn("fold", F.explode(F.sequence(F.col("_newer") + 1, oldest)))


def cv_folds(
    frame: DataFrame,
    by: Sequence[str],
    ts: str = "ds",
    initial: timedelta = INITIAL,
    horizon: timedelta = HORIZON,
    period: timedelta | None = None,
) -> DataFrame:
    """Cutoff and number of training and held-out rows of every fold."""
    period = period or horizon / 2
    keys = [*by, "fold"]
    placed = with_folds(frame.select(*by, ts), by, ts, initial, horizon, period)
    per_block = placed.groupBy(*by, "_last", "_folds", "_block").agg(F.count(F.lit(1)).alias("_n"))
    train = _running_folds(per_block, by, ["_n"]).select(
        *keys, _fold_cutoff(horizon, period).alias("cutoff"), F.col("_n").alias("train_rows")
    )
    test = (
        placed.select(*by, F.explode("_tests").alias("fold"))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("test_rows"))
    )
    return train.join(test, keys, "left").fillna(0, ["test_rows"])


# -- seasonal profile ---------------------------------------------------------------------------------------------


def _slot(ts: str) -> dict[str, Column]:
    return {"_weekday": F.weekday(F.col(ts)), "hour": F.hour(F.col(ts))}


def _profile_of_sums() -> list[Column]:
    """Mean and interval of a slot from its count, sum and sum of squares."""
    mean = F.col("_sum") / F.col("_n")
    spread = F.sqrt(F.greatest(F.col("_squares") / F.col("_n") - mean * mean, F.lit(0.0))) * HALF_WIDTH
    return [
        mean.alias("yhat"),
        (mean - spread).alias("yhat_lower"),
        (mean + spread).alias("yhat_upper"),
    ]


def _slot_sums(y: str = "y") -> list[Column]:
    value = F.col(y).cast("double")
    return [
        F.count(value).alias("_n"),
        F.sum(value).alias("_sum"),
        F.sum(value * value).alias("_squares"),
    ]


def seasonal_profile(history: DataFrame, by: Sequence[str] = ("station",), ts: str = "ds") -> DataFrame:
    """Mean of ``y`` per series, weekday and hour, with an 80 % interval."""
    sums = history.withColumns(_slot(ts)).groupBy(*by, "_weekday", "hour").agg(*_slot_sums())
    return sums.where(F.col("_n") > 0).select(
        *by, weekday_name(F.col("_weekday")).alias("day_of_week"), "hour", *_profile_of_sums()
    )


def apply_profile(times: DataFrame, profile: DataFrame, by: Sequence[str] = ("station",), ts: str = "ds") -> DataFrame:
    """Forecast each time from its weekday and hour; slots never seen stay null."""
    slots = times.withColumns(
        {"day_of_week": weekday_name(F.weekday(F.col(ts))), "hour": F.hour(F.col(ts))}
    )
    return slots.join(profile, [*by, "day_of_week", "hour"], "left").drop("day_of_week", "hour")


def cv_profile(
    history: DataFrame,
    by: Sequence[str] = ("station",),
    ts: str = "ds",
    initial: timedelta = INITIAL,
    horizon: timedelta = HORIZON,
    period: timedelta | None = None,
) -> DataFrame:
    """Held-out rows of every fold with the forecast of the profile fitted before its cutoff.

    Every held-out row stays. Where its weekday and hour were not seen before the cutoff, the forecast is the mean of
    the whole series up to then, with that mean's interval. Rows without ``y`` neither train nor are held out.
    """
    sums = ["_n", "_sum", "_squares"]
    slot = ["_weekday", "hour"]
    known = history.select(*by, ts, "y").where(F.col("y").isNotNull())
    placed = with_folds(known, by, ts, initial, horizon, period).withColumns(_slot(ts))
    per_slot = placed.groupBy(*by, "_folds", "_block", *slot).agg(*_slot_sums())
    per_series = per_slot.groupBy(*by, "_folds", "_block").agg(*[F.sum(c).alias(c) for c in sums])
    names = ["yhat", "yhat_lower", "yhat_upper"]
    fitted = _running_folds(per_slot, [*by, *slot], sums).select(*by, "fold", *slot, *_profile_of_sums())
    overall = _running_folds(per_series, by, sums).select(*by, "fold", *_profile_of_sums())
    overall = overall.withColumnsRenamed({c: f"_all_{c}" for c in names})
    held_out = placed.select(*by, ts, "y", *slot, F.explode("_tests").alias("fold"))
    scored = held_out.join(fitted, [*by, "fold", *slot], "left").join(overall, [*by, "fold"], "left")
    seen = F.col("yhat").isNotNull()
    return scored.select(*by, "fold", ts, "y", *[F.when(seen, F.col(c)).otherwise(F.col(f"_all_{c}")).alias(c) for c in names])


# -- regression terms ---------------------------------------------------------------------------------------------


def _waves(ts: str, period: float, order: int) -> list[Column]:
    days = _epoch(ts) / 86400.0
    turns = [days * (2 * math.pi * k / period) for k in range(1, order + 1)]
    return [f(t) for t in turns for f in (F.sin, F.cos)]


def seasonal_features(df: DataFrame, design: Design, ts: str = "ds") -> DataFrame:
    """Add ``season_x``, the seasonal, holiday and regressor terms of a row."""
    season = [w for period, order in design.seasonalities for w in _waves(ts, period, order)]
    if design.extra:
        season += _waves(ts, *design.extra)
    if design.holidays:
        season += holiday_flags(F.col(ts).cast("date"), design.holidays)
    season += [F.col(r).cast("double") for r in design.regressors]
    return df.withColumn("season_x", F.array(*season).cast("array<double>"))


def trend_features(df: DataFrame, design: Design, ts: str = "ds") -> DataFrame:
    """Add ``trend_x``. The input carries ``_first`` and ``_last``, the span of the series' history in epoch seconds.

    The trend runs from 0 to 1 over the span and may bend at changepoints: those in a column ``knots``, where the input
    has one from a model, or else those spread over its first four fifths.
    """
    t = (_epoch(ts) - F.col("_first")) / F.greatest(F.col("_last") - F.col("_first"), F.lit(1)).cast("double")
    start = F.array(F.lit(1.0), F.col("_t"))
    if "knots" in df.columns:
        hinges = F.transform("knots", lambda b: F.greatest(F.col("_t") - b, F.lit(0.0)))
    else:
        hinges = F.array(*[F.greatest(F.col("_t") - b, F.lit(0.0)) for b in design.bends()]).cast("array<double>")
    return df.withColumn("_t", t).withColumn("trend_x", F.concat(start, hinges)).drop("_t")


# -- settings -----------------------------------------------------------------------------------------------------


def param_grid(axes: Mapping[str, Sequence] = GRID) -> list[dict]:
    """Every combination of the axes."""
    return [dict(zip(axes, values)) for values in itertools.product(*axes.values())]


def with_settings(df: DataFrame, axes: Mapping[str, Sequence] = GRID) -> DataFrame:
    """Pair each row, such as a station, with every combination of the axes, as one generated column per axis."""
    for name, values in axes.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df


# -- fitting ------------------------------------------------------------------------------------------------------


def _matrix(table: pa.Table, column: str, width: int) -> np.ndarray:
    """An array column of fixed length as a matrix, without making an object per row."""
    return table[column].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, width)


def _block_sums(table: pa.Table, design: Design) -> dict:
    """Cross-products of the terms in one series and block, plain and weighted by the trend time and its square."""
    season = _matrix(table, "season_x", len(design.season_groups()))
    x = np.hstack([_matrix(table, "trend_x", design.trend_width), season])
    y = table["y"].to_numpy().astype(float)
    t = x[:, 1:2]
    upper = np.triu_indices(x.shape[1])
    crosses = [(x.T @ (x * w))[upper] for w in (1.0, t, t * t)]
    sides = [x.T @ y, x.T @ (y * t[:, 0])]
    return {
        "n": len(y),
        "y_max": float(np.abs(y).max()),
        "y_squares": float(y @ y),
        "sums": np.concatenate(crosses + sides),
    }


class _Sums:
    """Block sums of one series, added up; the trend time is that of the whole history."""

    def __init__(self, width: int, span: tuple[int, int] = (0, 1), bends: Sequence[float] = ()):
        self.width, self.n, self.y_max, self.y_squares = width, 0, 0.0, 0.0
        self.first, self.last, self._bends = *span, list(bends)
        self.flat = np.zeros(3 * (width * (width + 1) // 2) + 2 * width)

    def add(self, block) -> None:
        self.n += block.n
        self.y_max = max(self.y_max, block.y_max)
        self.y_squares += block.y_squares
        self.flat += block.sums

    def knots(self) -> list[float]:
        return self._bends

    def system(self, mode: str, trend_width: int):
        """Normal equations for a mode, and the line that multiplies the seasonal terms in it."""
        size = self.width * (self.width + 1) // 2
        crosses = []
        for i in range(3):
            m = np.zeros((self.width, self.width))
            m[np.triu_indices(self.width)] = self.flat[i * size : (i + 1) * size]
            crosses.append(m + np.triu(m, 1).T)
        plain, timed = self.flat[3 * size : 3 * size + self.width], self.flat[3 * size + self.width :]
        if mode == "additive":
            return crosses[0], plain, (1.0, 0.0)
        a, b = np.linalg.lstsq(crosses[0][:2, :2], plain[:2], rcond=None)[0]
        left, right = crosses[0].copy(), plain.copy()
        trend, season = slice(0, trend_width), slice(trend_width, None)
        left[trend, season] = (a * crosses[0] + b * crosses[1])[trend, season]
        left[season, trend] = left[trend, season].T
        left[season, season] = (a * a * crosses[0] + 2 * a * b * crosses[1] + b * b * crosses[2])[season, season]
        right[season] = (a * plain + b * timed)[season]
        return left, right, (float(a), float(b))

    def variances(self) -> np.ndarray:
        """Variance of each term over the rows seen."""
        m = np.zeros((self.width, self.width))
        m[np.triu_indices(self.width)] = self.flat[: self.width * (self.width + 1) // 2]
        return np.maximum(np.diag(m) / self.n - (m[0] / self.n) ** 2, 0.0)


def _penalties(design: Design, setting: Mapping, sums: _Sums | bent.OwnSums, noise: float) -> np.ndarray:
    """Ridge weights: noise variance over prior variance, terms in units of ``y`` scaled by its largest size.

    Under a Laplace prior the trend's changes have no ridge weight; their absolute penalty comes on top.
    """
    prior = {
        "season": setting["seasonality_prior_scale"],
        "extra": design.extra_prior,
        "holiday": setting["holidays_prior_scale"],
        "regressor": setting["holidays_prior_scale"],
    }
    scale = sums.y_max or 1.0
    trend = np.full(design.trend_width, setting["changepoint_prior_scale"] * scale)
    trend[:2] = 5.0 * scale
    groups = design.season_groups()
    season = np.array([prior[g] for g in groups])
    if setting["seasonality_mode"] == "additive":
        season = season * scale
    weights = noise / np.concatenate([trend, season]) ** 2
    weights[0] = 0.0
    if design.trend_prior == "laplace":
        weights[2 : design.trend_width] = 0.0
    standard = np.array([False] * design.trend_width + [g == "regressor" for g in groups])
    weights[standard] *= sums.variances()[standard]
    return weights


def _solve(left: np.ndarray, right: np.ndarray, weights: np.ndarray) -> np.ndarray:
    floor = 1e-9 * max(np.trace(left) / len(left), 1e-12)
    return np.linalg.solve(left + np.diag(weights + floor), right)


def _rss(sums: _Sums, left: np.ndarray, right: np.ndarray, coef: np.ndarray) -> float:
    return max(float(sums.y_squares - 2 * coef @ right + coef @ left @ coef), 0.0)


def _fit_all(sums: _Sums | bent.OwnSums, design: Design, grid: Sequence[Mapping]):
    """Coefficients of every setting from one set of sums."""
    systems = {}
    for mode in {s["seasonality_mode"] for s in grid}:
        left, right, lift = sums.system(mode, design.trend_width)
        loose = _solve(left, right, np.full(sums.width, 1e-6 * np.trace(left) / sums.width))
        systems[mode] = left, right, lift, max(_rss(sums, left, right, loose) / sums.n, 1e-12)
    for number, setting in enumerate(grid):
        left, right, lift, noise = systems[setting["seasonality_mode"]]
        weights = _penalties(design, setting, sums, noise)
        if design.trend_prior == "laplace" and design.changepoints:
            by = noise / (setting["changepoint_prior_scale"] * (sums.y_max or 1.0))
            coef = bent.solve_sparse(left, right, weights, design.trend_width, by)
        else:
            coef = _solve(left, right, weights)
        yield {
            "setting_id": number,
            **setting,
            "trend_coef": coef[: design.trend_width],
            "season_coef": coef[design.trend_width :],
            "lift_base": lift[0],
            "lift_slope": lift[1],
            "sigma": math.sqrt(_rss(sums, left, right, coef) / sums.n),
            "drift": bent.drift(coef[2 : design.trend_width]),
            "knots": sums.knots(),
            "train_rows": sums.n,
        }


_MODEL_TYPES = (
    "fold int, setting_id int, changepoint_prior_scale double, seasonality_prior_scale double, "
    "holidays_prior_scale double, seasonality_mode string, trend_coef array<double>, season_coef array<double>, "
    "lift_base double, lift_slope double, sigma double, drift double, knots array<double>, train_rows long, "
    "_first long, _last long"
)


def complete(frame: DataFrame, design: Design) -> DataFrame:
    """Rows that can train and be scored: those with ``y`` and every regressor."""
    for name in ("y", *design.regressors):
        frame = frame.where(F.col(name).isNotNull())
    return frame


def training_rows(frame: DataFrame, by: Sequence[str] = ("station",), design: Design = Design()) -> DataFrame:
    """Rows of each series, and how many of them lack ``y`` or a regressor and so neither train nor are scored."""
    lacking = F.lit(False)
    for name in ("y", *design.regressors):
        lacking = lacking | F.col(name).isNull()
    return frame.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.count_if(lacking).alias("left_out"))


def fit_panel(
    frame: DataFrame,
    by: Sequence[str] = ("station",),
    grid: Sequence[Mapping] = (DEFAULT_SETTING,),
    design: Design = Design(),
    ts: str = "ds",
    initial: timedelta = INITIAL,
    horizon: timedelta = HORIZON,
    period: timedelta | None = None,
    folds: bool = False,
) -> DataFrame:
    """Models of every series and setting: on all history, and with ``folds`` also before every cutoff.

    Rows without ``y`` or without one of the regressors neither train nor count for the placement of folds; the
    evaluation in :func:`cv_predict` places its folds on the same rows. Unless ``design.own_trend`` is set, trend time
    runs over the whole history in every fold, so an early fold has fewer bends before its cutoff than a fit of that
    part alone would get.

    ``frame`` has at most one row per series and hour, so a block holds at most one ``period`` of hours and a series
    at most one block per ``period`` of its history, whatever the number of trips behind them.
    """
    by = list(by)
    grid = [dict(s) for s in grid]
    placed = seasonal_features(with_folds(complete(frame, design), by, ts, initial, horizon, period), design, ts)
    types = {f.name: f.dataType.simpleString() for f in frame.schema.fields}
    keys = ", ".join(f"`{k}` {types[k]}" for k in by)
    group = [*by, "_first", "_last", "_folds", "_block"]
    seasons = len(design.season_groups())
    if design.own_trend:
        placed, terms = placed.withColumn("seconds", _epoch(ts)), ["seconds", "season_x"]
        more = "newest long, bins array<long>, bin_sums array<double>, "
    else:
        placed, terms, more = trend_features(placed, design, ts), ["trend_x", "season_x"], ""

    def block_sums(key: tuple, table: pa.Table) -> dict:
        if not design.own_trend:
            return _block_sums(table, design)
        y, seconds = table["y"].to_numpy().astype(float), bent.seconds_of(table, "seconds")
        return bent.own_block_sums(y, _matrix(table, "season_x", seasons), seconds, key[len(by)].as_py(), design.knot_grain)

    def block(key: tuple, table: pa.Table) -> pa.Table:
        names = {name: pa.array([value.as_py()], value.type) for name, value in zip(group, key)}
        return pa.table({**names, **{name: [value] for name, value in block_sums(key, table).items()}})

    sums = placed.select(*group, "y", *terms).groupBy(*group).applyInArrow(
        block,
        f"{keys}, _first long, _last long, _folds int, _block int, "
        f"n long, y_max double, y_squares double, {more}sums array<double>",
    )

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        first, last, count = (int(pdf[c].iloc[0]) for c in ("span_first", "span_last", "fold_count"))
        if design.own_trend:
            total = bent.OwnSums(seasons, design.changepoints, first, design.knot_grain)
        else:
            total = _Sums(design.trend_width + seasons, (first, last), design.bends())
        rows = []
        pending = list(pdf.sort_values("block_no", ascending=False).itertuples(index=False))
        for fold in [*range(count - 1 if folds else -1, -1, -1), ALL_HISTORY]:
            while pending and (fold == ALL_HISTORY or pending[0].block_no >= fold):
                total.add(pending.pop(0))
            if total.n:
                rows += [{"fold": fold, "_first": total.first, "_last": total.last, **m} for m in _fit_all(total, design, grid)]
        out = pd.DataFrame(rows)
        for name, value in zip(reversed(by), reversed(key)):
            out.insert(0, name, value)
        return out

    renamed = sums.withColumnsRenamed(
        {"_first": "span_first", "_last": "span_last", "_folds": "fold_count", "_block": "block_no"}
    )
    return renamed.groupBy(*by).applyInPandas(solve, f"{keys}, {_MODEL_TYPES}")


# -- prediction ---------------------------------------------------------------------------------------------------


def _dot(a: str, b: str) -> Column:
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def predict(rows: DataFrame, models: DataFrame, on: Sequence[str], design: Design, ts: str = "ds") -> DataFrame:
    """Forecast and 80 % interval of each row under the models it joins to.

    The seasonal terms depend on the row alone and are made before the join, once for all models of its series. All
    terms are Spark expressions, so forecasting needs no Python worker.

    The interval is that of the residuals, and widens beyond the history by the trend changes still to come (see
    :func:`dockflow.operators.trend.drift`); where the seasonal terms multiply the trend, they multiply those too.
    """
    on = list(on)
    terms = trend_features(seasonal_features(rows, design, ts).join(models, on), design, ts)
    lift = F.col("lift_base") + F.col("lift_slope") * F.col("trend_x")[1]
    terms = terms.withColumn("_season", _dot("season_x", "season_coef"))
    yhat = _dot("trend_x", "trend_coef") + lift * F.col("_season")
    ahead = F.greatest(F.col("trend_x")[1] - 1, F.lit(0.0))
    grown = F.when(F.col("seasonality_mode") == "multiplicative", 1 + F.col("_season")).otherwise(F.lit(1.0))
    width = F.sqrt(F.col("sigma") * F.col("sigma") + F.col("drift") * ahead * ahead * ahead * grown * grown) * HALF_WIDTH
    made = ["trend_x", "season_x", "_season", "trend_coef", "season_coef", "lift_base", "lift_slope", "sigma", "drift", "knots"]
    return (
        terms.withColumn("yhat", yhat)
        .withColumns({"yhat_lower": F.col("yhat") - width, "yhat_upper": F.col("yhat") + width})
        .drop(*made, "_first", "_last")
    )


def cv_predict(
    frame: DataFrame,
    models: DataFrame,
    by: Sequence[str] = ("station",),
    design: Design = Design(),
    ts: str = "ds",
    initial: timedelta = INITIAL,
    horizon: timedelta = HORIZON,
    period: timedelta | None = None,
) -> DataFrame:
    """Held-out rows of every fold under every setting's model of that fold, folds placed as :func:`fit_panel` does."""
    placed = with_folds(complete(frame, design), by, ts, initial, horizon, period).drop("_first", "_last", "_folds", "_block")
    held_out = placed.withColumn("fold", F.explode("_tests")).drop("_tests")
    return predict(held_out, models.where(F.col("fold") >= 0), [*by, "fold"], design, ts)


def score_settings(
    frame: DataFrame,
    models: DataFrame,
    by: Sequence[str] = ("station",),
    design: Design = Design(),
    ts: str = "ds",
    initial: timedelta = INITIAL,
    horizon: timedelta = HORIZON,
    period: timedelta | None = None,
) -> DataFrame:
    """The rows of :func:`cv_predict` for many settings: (by, setting, fold, ts, y, yhat, yhat_lower, yhat_upper).

    Where that one pairs every row with every setting's coefficients, here the held-out rows of a series and fold, at
    most one horizon of hours, meet the coefficients of all settings once, as two matrices. Nothing but the narrow
    result is repeated per setting.
    """
    by = list(by)
    placed = with_folds(complete(frame, design), by, ts, initial, horizon, period)
    rows = seasonal_features(placed, design, ts).withColumn("seconds", _epoch(ts)).withColumn("fold", F.explode("_tests"))
    rows = rows.select(*by, "fold", ts, F.col("y").cast("double").alias("y"), "seconds", "season_x")
    setting = ["setting_id", *SETTING_COLUMNS]
    columns = [*by, "fold", *setting, "trend_coef", "season_coef", "lift_base", "lift_slope", "sigma", "drift", "knots", "_first", "_last"]
    fitted = models.where(F.col("fold") >= 0).select(*columns)
    types = dict(rows.dtypes) | dict(fitted.dtypes)
    narrow = [*by, *setting, "fold", ts, "y", "yhat", "yhat_lower", "yhat_upper"]
    schema = ", ".join(f"`{c}` {types.get(c, 'double')}" for c in narrow)
    seasons = len(design.season_groups())

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({c: pa.array([], left.schema.field(c).type if c in left.column_names else right.schema.field(c).type if c in right.column_names else pa.float64()) for c in narrow})
        first, last = right["_first"][0].as_py(), right["_last"][0].as_py()
        t = (left["seconds"].to_numpy() - first) / max(last - first, 1)
        knots = np.array(right["knots"][0].as_py() or [], float)
        head = np.hstack([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - knots, 0.0)])
        season = _matrix(left, "season_x", seasons) @ _matrix(right, "season_coef", seasons).T
        of = lambda c: right[c].to_numpy()[None, :]
        yhat = head @ _matrix(right, "trend_coef", head.shape[1]).T + (of("lift_base") + of("lift_slope") * t[:, None]) * season
        product = np.array(right["seasonality_mode"].to_pylist())[None, :] == "multiplicative"
        ahead = np.maximum(t - 1, 0.0)[:, None] ** 3
        width = HALF_WIDTH * np.sqrt(of("sigma") ** 2 + of("drift") * ahead * np.where(product, 1 + season, 1.0) ** 2)
        n, k = yhat.shape
        row, model = pa.array(np.repeat(np.arange(n), k)), pa.array(np.tile(np.arange(k), n))
        made = {"yhat": yhat, "yhat_lower": yhat - width, "yhat_upper": yhat + width}
        parts = {c: left[c].take(row) if c in left.column_names else right[c].take(model) for c in narrow if c not in made}
        return pa.table({c: parts[c] if c in parts else pa.array(made[c].ravel()) for c in narrow})

    return rows.groupBy(*by, "fold").cogroup(fitted.groupBy(*by, "fold")).applyInArrow(score, schema)


def attach_regressors(
    future: DataFrame, features: DataFrame, by: Sequence[str] = ("station",), ts: str = "ds", block: str = "day"
) -> DataFrame:
    """Known regressors on their times, carried forward where they are not known."""
    names = [c for c in features.columns if c not in (*by, ts, "y")]
    if not names:
        return future
    joined = future.join(features.drop("y"), [*by, ts], "left")
    return forward_fill(joined, by, ts, names, block=block)


def forecast(
    history: DataFrame,
    models: DataFrame,
    by: Sequence[str] = ("station",),
    design: Design = Design(),
    ts: str = "ds",
    hours: int = 24,
) -> DataFrame:
    """Forecast of the history's hours and of the next ``hours``, under the models fitted on all history."""
    times = attach_regressors(future_frame(history, by, ts, hours), history, by, ts)
    final = models.where(F.col("fold") == ALL_HISTORY).drop("fold", "train_rows")
    return predict(times, final, by, design, ts)
