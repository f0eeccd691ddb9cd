"""Current state, running inventory, and the gold table of forecasts against observations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.stock import is_full, stock_status
from dockflow.functions.timeparts import hour_of
from dockflow.operators.asof import asof_join
from dockflow.operators.flows import as_of, recent
from dockflow.operators.series import forward_fill, running_total
from dockflow.sources.writers import settle
from dockflow.spec import DEFAULT_CAPACITY

LIVE_READINGS = ["temp", "pressure", "humidity", "wind_speed", "pop", "rain_1h"]


def latest_as_of(df: DataFrame, by: Sequence[str], ts: str, columns: Sequence[str], now=None) -> DataFrame:
    """Each key's newest row no later than ``now``.

    The newest times come from a hash aggregate, one row per key and task in its shuffle. Only rows of those times
    are compared further: rows of the same instant are told apart by the carried columns, the larger first. A key
    whose times are all null has its largest row.
    """
    if now is not None:
        df = as_of(df, ts, now)
    newest = df.groupBy(*by).agg(F.max(ts).alias("_ts")).withColumnsRenamed({c: f"_of_{c}" for c in by})
    match = F.col(ts).eqNullSafe(F.col("_ts"))
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    tied = df.select(*by, ts, *columns).join(newest, match, "left_semi")
    return tied.groupBy(*by, ts).agg(F.max(F.struct(*columns)).alias("_newest")).select(*by, ts, *[f"_newest.{c}" for c in columns])


def live_hourly_weather(weather: DataFrame, ts: str = "dt") -> DataFrame:
    """Live readings as one row per hour under the forecaster's names: gaps are 0 and so is snow, which is not sent."""
    means = [F.coalesce(F.avg(c), F.lit(0.0)).alias(f"avg_{c}") for c in LIVE_READINGS]
    return (
        weather.groupBy(hour_of(F.col(ts)).alias("date_hour"))
        .agg(*means)
        .withColumn("avg_snow_1h", F.lit(0.0))
    )


def status_with_weather(status: DataFrame, hourly: DataFrame, ts: str = "last_reported") -> DataFrame:
    """Status reports with the weather of their hour, reports without weather kept.

    Reports outnumber weather hours by far and most share few hours, so this must not be a shuffle by hour: Spark
    broadcasts the hourly side while it fits, and splits the hot hours when it does not.
    """
    return status.withColumn("date_hour", hour_of(F.col(ts))).join(hourly, "date_hour", "left")


def inference_frame(
    status: DataFrame,
    weather: DataFrame,
    now,
    hours: int = 4,
    by: str = "station_id",
    ts: str = "last_reported",
    weather_ts: str = "dt",
    within: timedelta | None = None,
) -> DataFrame:
    """Reports of the last hours with the regressors a model needs, gaps filled from the report before.

    A report has the weather of its own hour. With ``within`` an hour without weather has that of the newest earlier
    hour, if it is no older than that.
    """
    window = recent(status, ts, now, hours)
    older = -(-int(within.total_seconds()) // 3600) if within else 0
    readings = recent(weather, weather_ts, now, hours + 1 + older)
    # written first, the few hours of weather have a known size, and Spark sends them to the reports
    hourly = settle(live_hourly_weather(readings, weather_ts), "live-hours")
    if within:
        hourly_reports = window.withColumn("date_hour", hour_of(F.col(ts)))
        columns = [c for c in hourly.columns if c != "date_hour"]
        joined = asof_join(hourly_reports, hourly, "date_hour", "date_hour", columns=columns, tolerance=within)
    else:
        joined = status_with_weather(window, hourly, ts)
    regressors = [c for c in joined.columns if c.startswith("avg_")]
    filled = forward_fill(joined, [by], ts, regressors, ties=["num_bikes_available"])
    return filled.withColumnRenamed(ts, "ds").drop("date_hour")


def running_inventory(
    forecast: DataFrame,
    stock: DataFrame | Column | int,
    by: Sequence[str] = ("station",),
    ts: str = "ds",
    change: str = "yhat",
    block: str = "month",
) -> DataFrame:
    """Stock after each forecast step: the stock at the start plus the rounded changes so far.

    Halves round to the even neighbour. From the first missing forecast on, the stock is unknown and null. ``stock`` is a constant, a column, or a table of one
    ``num_bikes_available`` per series.
    """
    by = list(by)
    steps = forecast.withColumn("_change", F.bround(F.col(change)).cast("long"))
    moved = running_total(steps, by, ts, "_change", "_moved", block=block, strict=True).drop("_change")
    if isinstance(stock, DataFrame):
        start = stock.select(*by, F.col("num_bikes_available").alias("_start"))
        moved = moved.join(start, by, "left")
    else:
        moved = moved.withColumn("_start", stock if isinstance(stock, Column) else F.lit(stock))
    return moved.withColumn(
        "num_bikes_available", (F.col("_start") + F.col("_moved")).cast("long")
    ).drop("_start", "_moved")


def with_status(df: DataFrame, bikes: str = "num_bikes_available", capacity: str | None = None) -> DataFrame:
    """Add the stock message and the full-station alert; capacity defaults to the usual station's."""
    docks = F.col(capacity) if capacity else F.lit(DEFAULT_CAPACITY)
    return df.withColumns(
        {"status_message": stock_status(F.col(bikes), docks), "is_full": is_full(F.col(bikes), docks)}
    )


def forecast_vs_actual(
    forecast: DataFrame, observed: DataFrame, on: Sequence[str] = ("station", "ds"), value: str = "num_bikes_available"
) -> DataFrame:
    """Pairs of forecast (``_x``) and observed (``_y``) stock at the same station and time, with their difference."""
    on = list(on)
    pairs = forecast.withColumnRenamed(value, f"{value}_x").join(
        observed.select(*on, F.col(value).alias(f"{value}_y")), on
    )
    return pairs.withColumn("residual", F.col(f"{value}_x") - F.col(f"{value}_y"))


def gold_inventory(
    forecast: DataFrame,
    observed: DataFrame,
    stock: DataFrame | Column | int,
    by: Sequence[str] = ("station",),
    extra: Sequence[str] = (),
    capacity: str | None = None,
    block: str = "month",
) -> DataFrame:
    """Forecast stock with its message beside the observed stock, per series and time.

    ``extra`` are further columns of the forecast that belong to the series, such as model stage and version.
    """
    series = [*by, *extra]
    if isinstance(stock, DataFrame):
        start = stock.select(*by, F.col("num_bikes_available").alias("_stock"))
        forecast, stock = forecast.join(start, list(by), "left"), F.col("_stock")
    base = with_status(running_inventory(forecast, stock, series, block=block), capacity=capacity)
    return forecast_vs_actual(base, observed, [*by, "ds"]).select(
        *series, "ds", "num_bikes_available_x", "num_bikes_available_y", "residual", "status_message", "is_full"
    )
