"""Forecast quality: metrics, the best setting, and the shape of residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.operators.series import exact_percentiles, sketch_columns
from dockflow.sources.writers import settle

METRICS = ["mse", "rmse", "mae", "mdape", "coverage"]


def forecast_metrics(df: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] = METRICS) -> DataFrame:
    """Errors of ``yhat`` against ``y``, and the share of ``y`` inside ``yhat_lower``..``yhat_upper``.

    Means come from partial sums. The median relative error is exact and found without bringing a group together;
    rows with ``y = 0`` have no relative error. The rows are read twice: once for the means and a sketch of the relative
    errors, and once to count the few errors that the sketch leaves open.
    """
    by = list(by)
    error = F.col("yhat") - F.col("y")
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    means = {
        "mse": F.avg(error * error),
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "coverage": F.avg(inside.cast("double")),
    }
    columns = [c.alias(name) for name, c in means.items()]
    if "mdape" not in metrics:
        return df.groupBy(*by).agg(*columns).select(*by, *metrics)
    relative = F.abs(F.try_divide(error.cast("double"), F.col("y").cast("double")))
    scores = settle(df.groupBy(*by).agg(*columns, *sketch_columns(relative)), "metric-sketches")
    ape = df.select(*by, relative.alias("_ape"))
    median = exact_percentiles(ape, by, "_ape", [0.5], sketches=scores.select(*by, "_rows", "_plain", "_sketch"))
    scores = scores.drop("_rows", "_plain", "_sketch")
    median = median.withColumn("mdape", F.element_at("percentiles", 1)).drop("percentiles")
    # One row per group on either side: a union and an aggregate bring them together, null groups included.
    both = scores.unionByName(median, allowMissingColumns=True)
    return both.groupBy(*by).agg(*[F.max(m).alias(m) for m in metrics])


def coverage_by_horizon(
    df: DataFrame, by: Sequence[str] = (), ts: str = "ds", cutoff: str = "cutoff"
) -> DataFrame:
    """Rows, share of ``y`` inside the interval and mean width of it, per begun day between the cutoff and the row."""
    ahead = F.unix_timestamp(F.col(ts).cast("timestamp")) - F.unix_timestamp(F.col(cutoff).cast("timestamp"))
    inside = F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper"))
    return df.groupBy(*by, F.ceil(ahead / 86400).cast("int").alias("horizon_days")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(inside.cast("double")).alias("coverage"),
        F.avg(F.col("yhat_upper") - F.col("yhat_lower")).alias("width"),
    )


def best_params(results: DataFrame, params: Sequence[str], by: Sequence[str] = (), metric: str = "mae") -> DataFrame:
    """The setting with the smallest metric in each group; ties by setting."""
    best = F.min(F.struct(metric, *params)).alias("_best")
    ranked = results.where(F.col(metric).isNotNull())
    return ranked.groupBy(*by).agg(best).select(*by, *[f"_best.{c}" for c in [*params, metric]])


def residuals(forecast: DataFrame, history: DataFrame, on: Sequence[str] = ("station", "ds")) -> DataFrame:
    """Forecast minus observed at the same series and time."""
    on = list(on)
    return forecast.join(history.select(*on, "y"), on).withColumn("residual", F.col("yhat") - F.col("y"))


def residual_trend(df: DataFrame, by: Sequence[str] = (), x: str = "yhat", residual: str = "residual") -> DataFrame:
    """Least-squares line of the residual on the prediction."""
    y, x = F.col(residual).cast("double"), F.col(x).cast("double")
    return df.groupBy(*by).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.regr_count(y, x).alias("pairs"),
    )


def residual_distribution(
    df: DataFrame,
    by: Sequence[str] = (),
    residual: str = "residual",
    probabilities: Sequence[float] = (0.0, 0.25, 0.5, 0.75, 1.0),
) -> DataFrame:
    """Exact percentiles of the residual, one column ``p<percent>`` each."""
    spread = exact_percentiles(df, by, residual, probabilities)
    columns = [F.col("percentiles")[i].alias(f"p{round(p * 100):d}") for i, p in enumerate(probabilities)]
    return spread.select(*by, *columns)


def residual_histogram(
    df: DataFrame, low: float, high: float, bins: int, by: Sequence[str] = (), residual: str = "residual"
) -> DataFrame:
    """Residuals per equal-width bin of ``low``..``high``; bin 0 and bin ``bins + 1`` hold what lies outside."""
    value = F.col(residual).cast("double")
    spot = F.width_bucket(value, F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    return df.where(value.isNotNull()).groupBy(*by, spot.alias("bin")).agg(F.count(F.lit(1)).alias("count"))


#: Chance that a Poisson variable of mean 1 is at most 0, 1, 2, ..., in units of 1/65536.
_POISSON = (24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535)


def bootstrap_weights(keys: Sequence[Column], replicates: int) -> Column:
    """An array of Poisson weights of mean 1, one per replicate, from the MD5 of a row's keys: the same in every run."""
    name = F.concat_ws("|", *[k.cast("string") for k in keys])
    digests = [F.md5(F.concat(name, F.lit(f"|{n}"))) for n in range(-(-replicates // 8))]
    spots = [F.conv(F.substring(digests[r // 8], 4 * (r % 8) + 1, 4), 16, 10).cast("int") for r in range(replicates)]
    return F.array(*[sum((F.when(s >= edge, 1).otherwise(0) for edge in _POISSON), F.lit(0)) for s in spots])


def stage_difference(
    gold: DataFrame,
    by: Sequence[str] = (),
    on: Sequence[str] = ("station", "ds"),
    stages: tuple[str, str] = ("Staging", "Production"),
    replicates: int = 64,
    level: float = 0.9,
) -> DataFrame:
    """How much the mean absolute residual of one stage differs from the other's, with a bootstrap interval.

    The stages are paired at the same ``on``; times that only one of them has, or whose residual is null, are left out.
    ``better`` is the share of replicates in which the first stage has the smaller error. Each replicate weighs every
    pair by a hashed Poisson number, so all of them come from one aggregate and no pair is copied. Rows of one stage
    and time that repeat are averaged. Ends of the interval are the replicates nearest below and above its ranks.
    """
    by, on = list(by), list(on)
    size = [F.avg(F.when(F.col("stage") == s, F.abs(F.col("residual").cast("double")))).alias(f"_{i}") for i, s in enumerate(stages)]
    pairs = gold.groupBy(*dict.fromkeys([*by, *on])).agg(*size).where(F.col("_0").isNotNull() & F.col("_1").isNotNull())
    moment = lambda c: F.unix_timestamp(F.col(c).cast("timestamp")) if dict(gold.dtypes)[c].startswith("timestamp") else F.col(c)
    weighed = pairs.select(*by, (F.col("_0") - F.col("_1")).alias("_d"), bootstrap_weights([moment(c) for c in on], replicates).alias("_w"))
    drawn = [F.try_divide(F.sum(F.get("_w", F.lit(r)) * F.col("_d")), F.sum(F.get("_w", F.lit(r)))) for r in range(replicates)]
    found = weighed.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), F.avg("_d").alias("difference"), F.array(*drawn).alias("_draws"))
    # a replicate that gives no pair any weight, as happens with very few pairs, draws nothing
    found = found.where("pairs > 0").withColumn("_draws", F.array_sort(F.filter("_draws", lambda x: x.isNotNull())))
    last, tail = F.size("_draws") - 1, (1 - level) / 2
    smaller = F.size(F.filter("_draws", lambda x: x < 0)).cast("double")
    return found.select(
        *by,
        "pairs",
        "difference",
        F.get("_draws", F.floor(last * tail).cast("int")).alias("low"),
        F.get("_draws", F.ceil(last * (1 - tail)).cast("int")).alias("high"),
        F.try_divide(smaller, F.size("_draws").cast("double")).alias("better"),
    )


def compare_stages(gold: DataFrame, by: Sequence[str] = ("stage",)) -> DataFrame:
    """Size and trend of the residual of each model stage."""
    error = F.col("residual").cast("double")
    size = gold.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(error).alias("bias"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.regr_slope(error, F.col("num_bikes_available_x").cast("double")).alias("slope"),
        F.regr_intercept(error, F.col("num_bikes_available_x").cast("double")).alias("intercept"),
    )
    return size
