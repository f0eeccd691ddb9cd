"""One registered query per operator, over the driver's test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions import calendar as cal
from dockflow.functions import stock
from dockflow.functions.timeparts import epoch_to_text, epoch_to_ts, with_duration, with_time_parts
from dockflow.operators import asof, bounded, evaluation, explore, flows, forecast, inventory, quality, registry, series
from dockflow.plans import bindings as b
from dockflow.session import scratch_path
from dockflow.sources import ingest, readers, writers
from dockflow.spec import TRIPS_RAW
from dockflow.streaming import silver, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

NOW = "2024-01-20 12:00:00"
PANEL_DESIGN = forecast.Design(changepoints=3, seasonalities=((7.0, 3), (1.0, 4)), extra=None, regressors=())
WEATHER_DESIGN = forecast.Design(changepoints=2, seasonalities=((1.0, 2),), extra=None)
TREND_DESIGN = forecast.Design(changepoints=0, seasonalities=(), extra=None, holidays=None, regressors=())
TREND_SETTING = {**forecast.DEFAULT_SETTING, "seasonality_mode": "additive"}
BENT_DESIGN = replace(TREND_DESIGN, changepoints=1)
SPARSE_DESIGN = replace(BENT_DESIGN, trend_prior="laplace")
OWN_DESIGN = replace(BENT_DESIGN, own_trend=True)
PANEL_GRID = forecast.param_grid(
    {
        "changepoint_prior_scale": [0.01, 0.5],
        "seasonality_prior_scale": [0.1, 10.0],
        "holidays_prior_scale": [1.0],
        "seasonality_mode": ["additive", "multiplicative"],
    }
)


def _shown(df: DataFrame, digits: int) -> DataFrame:
    """Compare-ready columns: doubles rounded, negative zero made plain, instants as wall-clock time in UTC."""
    shown = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind == "double":
            c = F.round(c, digits) + F.lit(0.0)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        shown.append(c.alias(name))
    return df.select(*shown)


def query(digits: int = 6):
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return _shown(build(spark, sf_dir), digits)

        run.__name__, run.__doc__ = build.__name__, build.__doc__
        QUERIES[build.__name__] = run
        return run

    return register


# -- flows and silver ---------------------------------------------------------------------------------------------


@query()
def hourly_inbound(spark, sf):
    return flows.hourly_inbound(b.event_trips(spark, sf))


@query()
def hourly_outbound(spark, sf):
    return flows.hourly_outbound(b.event_trips(spark, sf))


@query()
def hourly_net_flow(spark, sf):
    return flows.hourly_net_flow(b.event_trips(spark, sf))


@query()
def hourly_net_flow_dense(spark, sf):
    return flows.hourly_net_flow(b.event_trips(spark, sf), densify=True)


@query()
def hourly_flows_joined(spark, sf):
    return flows.hourly_flows_joined(b.event_trips(spark, sf))


@query()
def od_net_flow(spark, sf):
    return flows.hourly_net_flow(b.od_trips(spark, sf))


@query()
def hourly_weather(spark, sf):
    return flows.hourly_weather(b.weather(spark, sf))


@query()
def flows_with_weather(spark, sf):
    hourly = writers.settle(flows.hourly_weather(b.weather(spark, sf)), "weather-hours")
    return flows.enrich_with_weather(flows.hourly_net_flow(b.event_trips(spark, sf)), hourly)


@query()
def silver_hourly(spark, sf):
    return b.silver(spark, sf)


@query()
def silver_station(spark, sf):
    """The silver table of one station, its filter applied in the scan."""
    return b.silver(spark, sf, station=3)


@query()
def model_frame(spark, sf):
    return b.weather_frame(spark, sf)


@query()
def daily_weather(spark, sf):
    return flows.daily_weather(b.weather(spark, sf))


# -- filters and time columns -------------------------------------------------------------------------------------


@query()
def station_departures(spark, sf):
    return flows.at_station(b.od_trips(spark, sf), "NATION_3", "start").select(
        "ride_id", "end_station_name", "started_at"
    )


@query()
def station_touching(spark, sf):
    return flows.touching_station(b.od_trips(spark, sf), "NATION_3").groupBy(
        "start_station_name", "end_station_name"
    ).agg(F.count(F.lit(1)).alias("trips"))


@query()
def without_round_trips(spark, sf):
    return flows.exclude_round_trips(b.od_trips(spark, sf)).groupBy("rideable_type").agg(
        F.count(F.lit(1)).alias("trips")
    )


@query()
def trip_duration(spark, sf):
    timed = with_duration(b.od_trips(spark, sf), "started_at", "ended_at")
    return timed.groupBy("duration_seconds", "trip_duration").agg(F.count(F.lit(1)).alias("trips"))


@query()
def time_parts(spark, sf):
    return with_time_parts(b.table(spark, sf, "events").select("event_id", "ts"), "ts", "start_").drop("ts")


@query()
def epoch_times(spark, sf):
    reports = b.raw_status(spark, sf).withColumn("epoch", F.col("last_reported"))
    return epoch_to_ts(epoch_to_text(reports, "epoch", "reported_text"), "last_reported").drop("epoch")


@query()
def period_filter(spark, sf):
    kept = flows.in_period(b.table(spark, sf, "orders"), "o_orderdate", "1996-01-01", "1997-01-01")
    return kept.select("o_orderkey", "o_orderdate")


@query()
def recent_window(spark, sf):
    return flows.as_of(flows.recent(b.status(spark, sf), "last_reported", NOW, 48), "last_reported", NOW)


@query()
def exact_hour(spark, sf):
    return flows.at_hour(b.table(spark, sf, "events"), "ts", NOW).select("event_id", "ts", "event_type")


# -- exploration --------------------------------------------------------------------------------------------------


@query()
def monthly_trips(spark, sf):
    return explore.monthly_trips(b.table(spark, sf, "orders"), spec=b.ORDERS)


@query()
def monthly_trips_station(spark, sf):
    return explore.monthly_trips(b.table(spark, sf, "orders"), "1-URGENT", b.ORDERS)


@query()
def daily_trips(spark, sf):
    return explore.daily_trips(b.table(spark, sf, "orders"), spec=b.ORDERS)


@query()
def daily_trips_station(spark, sf):
    return explore.daily_trips(b.table(spark, sf, "orders"), "1-URGENT", b.ORDERS)


@query()
def holiday_effect(spark, sf):
    return explore.holiday_effect(explore.daily_trips(b.table(spark, sf, "orders"), spec=b.ORDERS))


@query()
def holiday_effect_limited(spark, sf):
    daily = explore.daily_trips(b.table(spark, sf, "orders"), spec=b.ORDERS)
    flag = cal.is_off_day(F.col("date"), weekends=("1996-01-01", "1998-03-31"), years=(1996, 1998))
    return explore.holiday_effect(daily, flag)


@query()
def holiday_effect_table(spark, sf):
    daily = explore.daily_trips(b.table(spark, sf, "orders"), spec=b.ORDERS)
    # days off from a table: here those on which the number of shipped lines is a multiple of five
    shipped = b.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count(F.lit(1)).alias("lines"))
    days = shipped.where("lines % 5 = 0").select("date")
    return explore.holiday_effect(cal.flag_holidays(daily, "date", days), F.col("is_holiday"))


@query()
def holiday_flag(spark, sf):
    return cal.flag_holidays(explore.daily_trips(b.table(spark, sf, "orders"), spec=b.ORDERS), "date")


@query()
def calendar(spark, sf):
    return cal.calendar_of(b.table(spark, sf, "orders"), "o_orderdate")


@query()
def calendar_extended(spark, sf):
    return cal.calendar_of(b.table(spark, sf, "lineitem"), "l_shipdate", "extended")


@query()
def daily_trips_weather(spark, sf):
    daily = explore.daily_trips(b.all_event_trips(spark, sf))
    return explore.daily_trips_weather(daily, flows.daily_weather(b.weather(spark, sf)))


def _hourly_trips_weather(spark, sf):
    """Trips and weather by hour of each day: more pairs than days, and hours without rain."""
    trips = b.all_event_trips(spark, sf).groupBy(F.date_trunc("hour", "started_at").alias("date")).agg(
        F.count("ride_id").alias("trip_count")
    )
    readings = b.weather(spark, sf).groupBy(F.date_trunc("hour", "dt").alias("date")).agg(
        F.avg("temp").alias("avg_temperature"),
        F.avg("rain_1h").alias("avg_precipitation"),
        F.avg("wind_speed").alias("avg_wind_speed"),
    )
    return explore.daily_trips_weather(trips, readings)


@query()
def weather_correlation_zero(spark, sf):
    return explore.weather_correlation(_hourly_trips_weather(spark, sf), "zero")


@query()
def weather_correlation_skip(spark, sf):
    return explore.weather_correlation(_hourly_trips_weather(spark, sf), "skip")


@query()
def count_by_bike_type(spark, sf):
    return explore.value_counts(b.table(spark, sf, "lineitem"), "l_returnflag")


@query()
def count_by_rider_type(spark, sf):
    return explore.value_counts(b.table(spark, sf, "customer"), "c_mktsegment")


@query()
def status_counts(spark, sf):
    return explore.value_counts(b.raw_status(spark, sf), "station_status")


@query()
def hour_by_weekday(spark, sf):
    return explore.hour_by_weekday(b.all_event_trips(spark, sf))


@query()
def usage_matrix(spark, sf):
    return explore.usage_matrix(b.all_event_trips(spark, sf))


@query()
def weekday_weekend_by_hour(spark, sf):
    return explore.weekday_weekend_by_hour(b.all_event_trips(spark, sf))


@query()
def od_counts_out(spark, sf):
    return explore.od_counts(b.od_trips(spark, sf), side="start")


@query()
def od_counts_in(spark, sf):
    return explore.od_counts(b.od_trips(spark, sf), "NATION_3", side="end")


@query()
def top_partner_out(spark, sf):
    return explore.top_partner(explore.od_counts(b.od_trips(spark, sf), side="start"))


@query()
def top_partners_out(spark, sf):
    return explore.top_partners(explore.od_counts(b.od_trips(spark, sf), side="start"))


@query()
def top_partners_in(spark, sf):
    return explore.top_partners(explore.od_counts(b.od_trips(spark, sf), side="end"))


@query()
def station_coordinates(spark, sf):
    return explore.station_coordinates(b.od_trips(spark, sf))


# -- quality ------------------------------------------------------------------------------------------------------


@query()
def null_profile(spark, sf):
    return quality.null_profile(b.weather(spark, sf))


@query()
def duplicate_check(spark, sf):
    return quality.duplicate_check(b.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query()
def dedup_weather(spark, sf):
    """Readings share an hour as raw weather files share a time."""
    readings = b.weather(spark, sf).withColumn("hour", F.date_trunc("hour", "dt"))
    return quality.dedup(readings, ["hour"], ["dt", "temp", "pressure", "humidity"]).select(
        "hour", "dt", "temp", "pressure", "snow_1h", "rain_1h"
    )


@query()
def unique_values(spark, sf):
    return quality.unique_values(b.table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag"])


@query()
def complete_rows(spark, sf):
    return flows.complete_rows(b.weather(spark, sf), ["snow_1h", "rain_1h"]).select("dt", "temp", "snow_1h", "rain_1h")


# -- state and inventory ------------------------------------------------------------------------------------------


@query()
def latest_as_of(spark, sf):
    return inventory.latest_as_of(b.status(spark, sf), ["station"], "last_reported", ["num_bikes_available"], NOW)


@query()
def latest_rows(spark, sf):
    return explore.latest_rows(b.status(spark, sf), "last_reported", 100, ["event_id"])


@query()
def status_with_weather(spark, sf):
    hourly = inventory.live_hourly_weather(b.weather(spark, sf))
    return inventory.status_with_weather(b.status(spark, sf), writers.settle(hourly, "hourly"))


@query()
def inference_frame(spark, sf):
    return inventory.inference_frame(b.status(spark, sf), b.weather(spark, sf), NOW, 72, by="station")


def _status_rain(spark, sf):
    rain = b.weather(spark, sf).groupBy(F.date_trunc("hour", "dt").alias("date_hour")).agg(
        F.avg("rain_1h").alias("avg_rain"), F.avg("snow_1h").alias("avg_snow")
    )
    return inventory.status_with_weather(b.status(spark, sf), writers.settle(rain, "hourly"))


@query()
def forward_fill(spark, sf):
    filled = series.forward_fill(
        _status_rain(spark, sf), ["station"], "last_reported", ["avg_rain", "avg_snow"], ties=["event_id"]
    )
    return filled.drop("date_hour")


@query()
def asof_weather(spark, sf):
    """Every report with the newest weather reading before it, if that is at most half an hour old."""
    return asof.asof_join(
        b.status(spark, sf), b.weather(spark, sf), "last_reported", "dt", columns=["dt", "temp", "pressure", "rain_1h"], tolerance=timedelta(minutes=30)
    )


@query()
def asof_stock(spark, sf):
    """Every departure with the station's last report, whenever that was."""
    reports = b.status(spark, sf).withColumnRenamed("station", "start_station_name")
    return asof.asof_join(
        b.all_event_trips(spark, sf), reports, "started_at", "last_reported", ["start_station_name"], ["last_reported", "num_bikes_available"], prefix="seen_"
    )


@query()
def running_inventory(spark, sf):
    forecasts = b.fitted_profile(spark, sf)
    return inventory.running_inventory(forecasts, 50, block="week")


@query()
def running_bikes(spark, sf):
    """Running total straight over the reports, many to a station and day."""
    return series.running_total(
        b.status(spark, sf), ["station"], "last_reported", "num_bikes_available", "bikes_so_far", ["event_id"], "day"
    )


@query()
def stock_status(spark, sf):
    bikes = F.col("num_bikes_available")
    return b.status(spark, sf).select(
        "event_id",
        "num_bikes_available",
        stock.stock_status(bikes, F.lit(105)).alias("status_message"),
        stock.is_full(bikes, F.lit(105)).alias("is_full"),
    )


@query()
def forecast_vs_actual(spark, sf):
    forecasts = inventory.running_inventory(b.fitted_profile(spark, sf), 50)
    return inventory.forecast_vs_actual(forecasts, b.hourly_status(spark, sf))


def _gold(spark, sf):
    """Two stages of the same model: the profile, and the profile at half its size."""
    forecasts = forecast.with_settings(
        b.fitted_profile(spark, sf), {"stage": ["Staging", "Production"]}
    ).withColumn("yhat", F.when(F.col("stage") == "Staging", F.col("yhat")).otherwise(F.col("yhat") / 2))
    first = inventory.latest_as_of(b.status(spark, sf), ["station"], "last_reported", ["num_bikes_available"], NOW)
    return inventory.gold_inventory(
        forecasts, b.hourly_status(spark, sf), first, extra=["stage"], block="week"
    )


@query()
def gold_inventory(spark, sf):
    return _gold(spark, sf)


@query()
def bounded_inventory(spark, sf):
    """Forecast stock of stations with 53 docks that start with 50 bikes, and the riders whom the bounds turn away."""
    steps = b.fitted_profile(spark, sf).withColumn("yhat", F.col("yhat") * 3)
    return bounded.bounded_inventory(steps, 50, capacity=53)


@query()
def stage_difference(spark, sf):
    """The stages' errors compared per station, with an interval from 64 weighted replicates."""
    return evaluation.stage_difference(_gold(spark, sf), ["station"])


@query()
def compare_stages(spark, sf):
    return evaluation.compare_stages(_gold(spark, sf), ["station", "stage"])


# -- forecasting --------------------------------------------------------------------------------------------------


@query()
def future_frame(spark, sf):
    return series.future_frame(b.flow_frame(spark, sf), ["station"], "ds", 24)


@query()
def attach_regressors(spark, sf):
    ahead = series.future_frame(b.flow_frame(spark, sf), ["station"], "ds", 24)
    known = writers.settle(b.weather_frame(spark, sf), "features")
    return forecast.attach_regressors(ahead, known)


@query()
def seasonal_profile(spark, sf):
    return forecast.seasonal_profile(b.flow_frame(spark, sf))


@query()
def profile_forecast(spark, sf):
    frame = b.flow_frame(spark, sf)
    ahead = series.future_frame(frame, ["station"], "ds", 24)
    return forecast.apply_profile(ahead, forecast.seasonal_profile(frame))


@query()
def cv_folds(spark, sf):
    return forecast.cv_folds(b.flow_frame(spark, sf), ["station"], **b.SCHEME)


def _cv(spark, sf):
    return forecast.cv_profile(b.flow_frame(spark, sf), **b.SCHEME)


@query()
def cv_predictions(spark, sf):
    return _cv(spark, sf)


@query()
def cv_metrics(spark, sf):
    return evaluation.forecast_metrics(writers.settle(_cv(spark, sf), "cv"), ["station"])


@query()
def cv_metrics_overall(spark, sf):
    return evaluation.forecast_metrics(writers.settle(_cv(spark, sf), "cv"))


def _shrunk_metrics(spark, sf):
    sized = forecast.with_settings(_cv(spark, sf), {"shrink": [0.0, 0.25, 0.5, 0.75, 1.0]})
    for name in ("yhat", "yhat_lower", "yhat_upper"):
        sized = sized.withColumn(name, F.col(name) * F.col("shrink"))
    return evaluation.forecast_metrics(sized, ["station", "shrink"], ["mae"])


@query()
def best_params(spark, sf):
    return evaluation.best_params(_shrunk_metrics(spark, sf), ["shrink"], ["station"])


@query()
def param_grid(spark, sf):
    stations = b.table(spark, sf, "events").select((F.col("user_id") % 10).alias("station")).distinct()
    return forecast.with_settings(stations, forecast.GRID)


def _cv_residuals(spark, sf):
    cv = _cv(spark, sf)
    return cv.withColumn("residual", F.col("yhat") - F.col("y"))


@query()
def forecast_residuals(spark, sf):
    frame = b.flow_frame(spark, sf)
    forecasts = forecast.apply_profile(frame.select("station", "ds"), forecast.seasonal_profile(frame))
    return evaluation.residuals(forecasts, frame).select("station", "ds", "yhat", "y", "residual")


@query()
def residual_trend(spark, sf):
    return evaluation.residual_trend(_cv_residuals(spark, sf), ["station"])


@query()
def residual_distribution(spark, sf):
    return evaluation.residual_distribution(writers.settle(_cv_residuals(spark, sf), "cv"), ["station"])


@query()
def residual_histogram(spark, sf):
    return evaluation.residual_histogram(_cv_residuals(spark, sf), -2.05, 2.05, 10, ["station"])


@query()
def price_percentiles(spark, sf):
    """Exact percentiles of a column with many distinct values, and of one with few."""
    items = b.table(spark, sf, "lineitem")
    pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).alias("amount")) for c in ("l_extendedprice", "l_quantity")])
    long = items.select("l_returnflag", F.explode(pairs).alias("m")).select("l_returnflag", "m.*")
    spread = evaluation.residual_distribution(long, ["l_returnflag", "measure"], "amount", (0.05, 0.5, 0.95))
    of = lambda name, column: F.max(F.when(F.col("measure") == name, F.col(column)))
    return spread.groupBy("l_returnflag").agg(
        *[of("l_extendedprice", c).alias(c) for c in ("p5", "p50", "p95")], of("l_quantity", "p50").alias("quantity_p50")
    )


@query()
def percentiles_with_nan(spark, sf):
    """Percentiles where some values are not numbers or infinite, in Spark's order of them."""
    items = b.table(spark, sf, "lineitem")
    value = (
        F.when(F.col("l_linenumber") == 1, float("nan"))
        .when(F.col("l_linenumber") == 2, float("-inf"))
        .when(F.col("l_linenumber") == 3, float("inf"))
        .otherwise(F.col("l_quantity"))
    )
    odd = items.select("l_returnflag", value.alias("amount"))
    found = evaluation.residual_distribution(odd, ["l_returnflag"], "amount", (0.0, 0.2, 0.45, 0.7, 1.0))
    return found.select("l_returnflag", *[F.col(c).cast("string").alias(c) for c in found.columns[1:]])


@query()
def regression_terms(spark, sf):
    """Seasonal, holiday and trend terms of every row, as the regression sees them."""
    design = forecast.Design(changepoints=1, seasonalities=((7.0, 1), (1.0, 1)), extra=None, regressors=())
    frame = b.flow_frame(spark, sf)
    spans = forecast.series_spans(frame, ["station"], "ds", **b.SCHEME)
    terms = forecast.trend_features(forecast.seasonal_features(frame.join(spans, "station"), design), design)
    season, trend = F.col("season_x"), F.col("trend_x")
    names = ["sin_week", "cos_week", "sin_day", "cos_day"]
    return terms.select(
        "station",
        "ds",
        *[F.get(season, F.lit(i)).alias(n) for i, n in enumerate(names)],
        F.aggregate(F.slice(season, 5, 1000), F.lit(0.0), lambda a, x: a + x).alias("holidays"),
        F.get(trend, F.lit(1)).alias("trend"),
        F.get(trend, F.lit(2)).alias("bend"),
    )


@query()
def ridge_forecast(spark, sf):
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], design=PANEL_DESIGN, **b.SCHEME)
    return forecast.forecast(frame, models, ["station"], PANEL_DESIGN).select(
        "station", "ds", "is_future", "seasonality_mode", "yhat", "yhat_lower", "yhat_upper"
    )


@query()
def ridge_trend_forecast(spark, sf):
    """Trend only: two coefficients, few enough to state in SQL."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], [TREND_SETTING], TREND_DESIGN, **b.SCHEME)
    return forecast.forecast(frame, models, ["station"], TREND_DESIGN).select("station", "ds", "is_future", "yhat")


@query()
def ridge_trend_cv(spark, sf):
    """The same on every fold."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], [TREND_SETTING], TREND_DESIGN, folds=True, **b.SCHEME)
    held_out = forecast.cv_predict(frame, models, ["station"], TREND_DESIGN, **b.SCHEME)
    return held_out.select("station", "fold", "ds", "y", "yhat", "train_rows")


@query()
def sparse_trend_forecast(spark, sf):
    """A trend that bends once, under an absolute penalty on the bend: soft thresholding, as SQL can state it."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], [TREND_SETTING], SPARSE_DESIGN, **b.SCHEME)
    return forecast.forecast(frame, models, ["station"], SPARSE_DESIGN).select("station", "ds", "is_future", "yhat")


@query()
def sparse_trend_models(spark, sf):
    """Coefficients of that trend for three widths of the prior: the narrower, the more bends are exactly 0."""
    frame = b.flow_frame(spark, sf)
    grid = [{**TREND_SETTING, "changepoint_prior_scale": scale} for scale in (0.001, 0.02, 0.5)]
    models = forecast.fit_panel(frame, ["station"], grid, SPARSE_DESIGN, **b.SCHEME)
    coef = [F.get("trend_coef", F.lit(i)).alias(name) for i, name in enumerate(("level", "slope", "bend"))]
    return models.select("station", "changepoint_prior_scale", *coef, "sigma")


@query()
def own_trend_cv(spark, sf):
    """A bend in the first four fifths of every fold's own history, on the grid of days that all folds share."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], [TREND_SETTING], OWN_DESIGN, folds=True, **b.SCHEME)
    held_out = forecast.cv_predict(frame, models, ["station"], OWN_DESIGN, **b.SCHEME)
    return held_out.select("station", "fold", "ds", "y", "yhat", "train_rows")


@query()
def forecast_intervals(spark, sf):
    """Intervals of held-out rows, which widen with the distance from each fold's cutoff."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], [TREND_SETTING], OWN_DESIGN, folds=True, **b.SCHEME)
    held_out = forecast.cv_predict(frame, models, ["station"], OWN_DESIGN, **b.SCHEME)
    return held_out.select("station", "fold", "ds", "yhat_lower", "yhat_upper")


@query()
def interval_coverage(spark, sf):
    """Share of held-out rows inside the interval, and its mean width, per day after the cutoff."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], [TREND_SETTING], OWN_DESIGN, folds=True, **b.SCHEME)
    held_out = forecast.cv_predict(frame, models, ["station"], OWN_DESIGN, **b.SCHEME)
    cutoffs = forecast.cv_folds(frame, ["station"], **b.SCHEME).select("station", "fold", "cutoff")
    return evaluation.coverage_by_horizon(held_out.join(cutoffs, ["station", "fold"]))


@query()
def ridge_weather_forecast(spark, sf):
    frame = writers.settle(b.weather_frame(spark, sf), "features")
    models = forecast.fit_panel(frame, ["station"], design=WEATHER_DESIGN, **b.SCHEME)
    return forecast.forecast(frame, models, ["station"], WEATHER_DESIGN).select(
        "station", "ds", "is_future", "yhat", "yhat_lower", "yhat_upper"
    )


@query()
def ridge_grid_search(spark, sf):
    """Every setting evaluated on every fold of every station, and the best one of each station."""
    frame = b.flow_frame(spark, sf)
    models = forecast.fit_panel(frame, ["station"], PANEL_GRID, PANEL_DESIGN, folds=True, **b.SCHEME)
    held_out = forecast.score_settings(frame, models, ["station"], PANEL_DESIGN, **b.SCHEME)
    scores = evaluation.forecast_metrics(held_out, ["station", *forecast.SETTING_COLUMNS], ["mae"])
    return evaluation.best_params(scores, forecast.SETTING_COLUMNS, ["station"])


@query()
def sparse_grid_search(spark, sf):
    """Three widths of the prior on each fold's bend, all measures of each, and the best one of each station."""
    design = replace(OWN_DESIGN, trend_prior="laplace")
    frame = b.flow_frame(spark, sf)
    grid = [{**TREND_SETTING, "changepoint_prior_scale": scale} for scale in (0.001, 0.02, 0.5)]
    models = writers.settle(forecast.fit_panel(frame, ["station"], grid, design, folds=True, **b.SCHEME), "models")
    held_out = forecast.score_settings(frame, models, ["station"], design, **b.SCHEME)
    scores = evaluation.forecast_metrics(held_out, ["station", "changepoint_prior_scale"])
    # settings without a bend tie; rounded, the smaller one wins whatever the order of summation
    rounded = scores.withColumns({m: F.round(m, 9) for m in evaluation.METRICS})
    best = evaluation.best_params(rounded, ["changepoint_prior_scale"], ["station"]).drop("mae")
    return rounded.join(best, ["station", "changepoint_prior_scale"])


@query()
def full_grid_search(spark, sf):
    """The whole grid with the terms, the prior and the fold trends that training uses, apart from weather."""
    design = replace(forecast.FULL_DESIGN, regressors=())
    frame = b.flow_frame(spark, sf)
    models = writers.settle(forecast.fit_panel(frame, ["station"], forecast.param_grid(), design, folds=True, **b.SCHEME), "models")
    held_out = forecast.score_settings(frame, models, ["station"], design, **b.SCHEME)
    scores = evaluation.forecast_metrics(held_out, ["station", *forecast.SETTING_COLUMNS], ["mae"])
    return evaluation.best_params(scores, forecast.SETTING_COLUMNS, ["station"])


# -- registry -----------------------------------------------------------------------------------------------------


@query()
def registry_latest(spark, sf):
    """Each event moves a model version to the stage its type stands for."""
    stage = F.when(F.col("event_type").isin("click", "error"), "Staging").when(
        F.col("event_type") == "view", "Production"
    ).when(F.col("event_type") == "purchase", "Archived").otherwise("None")
    log = b.table(spark, sf, "events").select(
        F.format_string("station_%d", F.col("user_id") % 10).alias("model_name"),
        F.floor(F.col("user_id") / 10).cast("int").alias("version"),
        F.lit("transition").alias("event"),
        stage.alias("stage"),
        F.col("ts").alias("event_ts"),
    )
    return registry.latest_versions(log)


@query()
def registry_lifecycle(spark, sf):
    """Two versions of every station's model; the first goes to production, the second is staged."""
    path = scratch_path(spark, "registry")
    registry.create_registry(spark, path)
    held_out = writers.settle(_cv(spark, sf), "cv")
    scores = writers.settle(evaluation.forecast_metrics(held_out, ["station"]), "scores")
    models = scores.select(
        F.format_string("station_%d", "station").alias("model_name"),
        F.create_map(F.lit("kind"), F.lit("profile")).alias("params"),
        F.create_map(F.lit("mae"), F.col("mae")).alias("metrics"),
    )
    registry.register_versions(path, models, datetime(2024, 2, 1))
    registry.transition_stage(path, registry.open_registry(spark, path), "Production", datetime(2024, 2, 2))
    registry.register_versions(path, models, datetime(2024, 2, 3))
    second = registry.open_registry(spark, path).where("version = 2")
    registry.transition_stage(path, second, "Staging", datetime(2024, 2, 4))
    return registry.latest_versions(registry.open_registry(spark, path))


# -- files and streams --------------------------------------------------------------------------------------------

_CSV = {"header": True, "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
_TRIP_COLUMNS = ["ride_id", "start_station_name", "end_station_name", "started_at", "ended_at"]


def _csv_trips(spark, sf):
    trips = b.event_trips(spark, sf)
    return trips.withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "ended_at")})


@query()
def csv_round_trip(spark, sf):
    """Trips out to headered text in the contract's columns and back."""
    path = scratch_path(spark, "csv")
    trips = _csv_trips(spark, sf).withColumns({c: F.col(c).cast("string") for c in _TRIP_COLUMNS[:3]})
    writers.write_table(readers.to_contract(trips, TRIPS_RAW), path, "csv", **_CSV)
    return readers.read_trips_csv(spark, path).select(_TRIP_COLUMNS)


@query()
def csv_union(spark, sf):
    """Two layouts of the same files in one folder, united by header name."""
    path = scratch_path(spark, "csv")
    trips = _csv_trips(spark, sf)
    arrivals = trips.where(F.col("ended_at").isNotNull()).select("ride_id", "ended_at", "end_station_name")
    departures = trips.where(F.col("started_at").isNotNull()).select(
        "start_station_name", "started_at", "ride_id", F.lit("x").alias("surplus")
    )
    writers.write_table(arrivals, path, "csv", **_CSV)
    writers.write_table(departures, path, "csv", mode="append", **_CSV)
    return readers.read_trips_csv(spark, path, mixed_headers=True).select(_TRIP_COLUMNS)


@query()
def weather_csv(spark, sf):
    """Raw weather files, dotted names and epoch seconds, to bronze form."""
    path = scratch_path(spark, "csv")
    writers.write_table(b.raw_weather(spark, sf), path, "csv", header=True)
    bronze = epoch_to_ts(readers.clean_names(readers.read_weather_csv(spark, path)), "dt")
    return bronze.select("dt", "temp", "pressure", "humidity", "wind_speed", "pop", "rain_1h", "snow_1h", "main")


@query()
def csv_inferred(spark, sf):
    path = scratch_path(spark, "csv")
    orders = b.table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    writers.write_table(orders, path, "csv", header=True)
    return readers.read_csv_inferred(spark, path).select(F.col("o_orderkey").cast("long"), "o_totalprice", "o_orderpriority")


@query()
def clustered_round_trip(spark, sf):
    """A table laid out by ship date answers a range of dates."""
    path = scratch_path(spark, "clustered")
    items = b.table(spark, sf, "lineitem").select("l_shipdate", "l_orderkey", "l_returnflag", "l_quantity")
    writers.write_table(writers.cluster_by(items, "l_shipdate", spread=["l_orderkey"]), path)
    kept = flows.in_period(readers.read_table(spark, path), "l_shipdate", "1996-01-01", "1996-07-01")
    return kept.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("l_quantity").alias("quantity")
    )


@query()
def balanced_round_trip(spark, sf):
    path = scratch_path(spark, "balanced")
    writers.write_table(writers.balance(b.weather(spark, sf)), path, "orc")
    return readers.read_table(spark, path, "orc").select("dt", "temp", "pressure", "rain_1h")


@query()
def published_table(spark, sf):
    """Written once, read by name."""
    path = scratch_path(spark, "published")
    name = "published_" + path.rsplit("-", 1)[1]
    writers.publish(b.raw_status(spark, sf), path, name)
    return explore.value_counts(spark.table(name), "station_id")


@query()
def table_detail(spark, sf):
    detail = writers.table_detail(b.table(spark, sf, "lineitem"))
    return detail.select("num_rows", "num_columns", (F.col("size_in_bytes") > 0).alias("has_bytes"))


@query()
def stream_status(spark, sf):
    """Reports through the append stream, started again on the same checkpoint: nothing is lost or repeated."""
    src, dst, check = (scratch_path(spark, f"status-{part}") for part in ("in", "out", "check"))
    writers.write_table(b.raw_status(spark, sf), src)
    for _ in range(2):
        streams.stream_status(spark, src, dst, check, trigger=None).awaitTermination()
    return readers.read_table(spark, dst)


@query()
def stream_weather(spark, sf):
    src, dst, check = (scratch_path(spark, f"weather-{part}") for part in ("in", "out", "check"))
    writers.write_table(b.raw_weather(spark, sf), src)
    streams.stream_weather(spark, src, dst, check, trigger=None).awaitTermination()
    return readers.read_table(spark, dst)


@query()
def stream_dedup(spark, sf):
    """Every report sent twice, at most one per station and second kept."""
    src, dst, check = (scratch_path(spark, f"dedup-{part}") for part in ("in", "out", "check"))
    reports = b.raw_status(spark, sf)
    writers.write_table(reports.unionByName(reports), src)
    streams.stream_status(spark, src, dst, check, trigger=None, dedup_within="60 days").awaitTermination()
    return readers.read_table(spark, dst).select("station_id", "last_reported")


@query()
def stream_duplicate_check(spark, sf):
    """What a stream without deduplication wrote, checked as a batch."""
    src, dst, check = (scratch_path(spark, f"check-{part}") for part in ("in", "out", "check"))
    reports = b.raw_status(spark, sf)
    writers.write_table(reports.unionByName(reports), src)
    streams.stream_status(spark, src, dst, check, trigger=None, files_per_batch=100).awaitTermination()
    return quality.duplicate_check(readers.read_table(spark, dst), ["station_id", "last_reported"])


@query()
def stream_dedup_batches(spark, sf):
    """The same over several micro-batches: the repeats come in a later delivery than the reports."""
    src, dst, check = (scratch_path(spark, f"batches-{part}") for part in ("in", "out", "check"))
    reports = b.raw_status(spark, sf)
    for _ in range(3):
        writers.write_table(reports, src, mode="append")
        streams.stream_status(spark, src, dst, check, None, dedup_within="60 days").awaitTermination()
    return readers.read_table(spark, dst).select("station_id", "last_reported")


@query()
def stream_counts(spark, sf):
    """What a finished stream reports of its last micro-batch."""
    src, dst, check = (scratch_path(spark, f"progress-{part}") for part in ("in", "out", "check"))
    writers.write_table(b.raw_status(spark, sf), src)
    running = streams.stream_status(spark, src, dst, check, trigger=None)
    running.awaitTermination()
    progress = streams.stream_progress(running)
    return spark.range(1).select(
        F.lit(progress["batch"]).cast("int").alias("batch"),
        F.lit(progress["input_rows"]).cast("long").alias("input_rows"),
        F.lit(progress["late_rows"]).cast("long").alias("late_rows"),
    )


def _arrival(ts: str, key: str) -> Column:
    """Which of five deliveries a row comes with: that of its week, or for every seventh row the one after."""
    return F.least(F.floor((F.dayofmonth(ts) - 1) / 8), F.lit(3)) + F.when(F.col(key) % 7 == 3, 1).otherwise(0)


@query()
def stream_silver(spark, sf):
    """Silver from five deliveries of trips and weather, a seventh of each late, worked off as they come."""
    trips_in, weather_in = (scratch_path(spark, f"silver-{part}") for part in ("trips", "weather"))
    log, table, check = silver.work_folders(spark)
    at = F.coalesce("started_at", "ended_at")
    trips = b.event_trips(spark, sf).withColumn("at", at).withColumn("delivery", _arrival("at", "ride_id")).drop("at")
    weather = b.weather(spark, sf).withColumn("delivery", _arrival("dt", "pressure"))
    station = trips.schema["start_station_name"].dataType.simpleString()
    for number in range(5):
        for rows, path in ((trips, trips_in), (weather, weather_in)):
            writers.write_table(rows.where(F.col("delivery") == number).drop("delivery"), path, mode="append")
        sources = [readers.stream_table(spark, path, rows.drop("delivery").schema) for rows, path in ((trips, trips_in), (weather, weather_in))]
        silver.stream_silver(*sources, log, table, check, delay="24 days", station=station).awaitTermination()
    return silver.read_silver(spark, table)


@query()
def ingest_twice(spark, sf):
    """Trips in two deliveries of files with different headers; the second run reads the new files only."""
    src, dst, check = (scratch_path(spark, f"ingest-{part}") for part in ("in", "out", "check"))
    trips = b.event_trips(spark, sf)
    columns = ["ride_id", "start_station_name", "end_station_name", "started_at", "ended_at"]
    first = trips.where("ride_id % 3 = 0").select([F.col(c).cast("string") for c in columns])
    second = trips.where("ride_id % 3 != 0").select([F.col(c).cast("string") for c in reversed(columns)])
    contract = {c: TRIPS_RAW[c] for c in columns}
    for part in (first, second):
        writers.write_table(part, src, "csv", "append", header=True)
        ingest.ingest_new_files(spark, src, dst, check, contract)
    return ingest.read_ingested(spark, dst)


@query()
def managed_table(spark, sf):
    """A table that the catalog owns, in a database of its own, replaced once and read by name."""
    name = "dock_" + scratch_path(spark, "managed").rsplit("-", 1)[1]
    before = spark.catalog.currentDatabase()
    writers.ensure_database(spark, name)
    try:
        writers.save_managed(b.raw_status(spark, sf).limit(0), "status")
        writers.save_managed(b.raw_status(spark, sf), "status")
        return writers.settle(explore.value_counts(spark.table(f"`{name}`.status"), "station_status"), "status-counts")
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE `{name}` CASCADE")


@query()
def table_files(spark, sf):
    """Files and rows of a table balanced to three files."""
    path = scratch_path(spark, "files")
    writers.write_table(writers.balance(b.table(spark, sf, "lineitem").select("l_orderkey", "l_tax"), 3), path)
    return writers.table_detail(readers.read_table(spark, path)).select("num_files", "num_rows", "num_columns")


@query()
def ordered_months(spark, sf):
    """Months in order of time, each with its place."""
    months = explore.monthly_trips(b.table(spark, sf, "orders"), spec=b.ORDERS).orderBy("year", "month")
    path = scratch_path(spark, "ordered")
    writers.write_table(months.coalesce(1), path)
    placed = readers.read_table(spark, path).withColumn("place", F.monotonically_increasing_id())
    return placed.select("year_month", "trip_count", "place")


@query()
def first_rows(spark, sf):
    """How many of any hundred orders there are."""
    return explore.first_rows(b.table(spark, sf, "orders"), 100).agg(F.count(F.lit(1)).alias("rows"))


def _damaged_csv(spark, sf) -> str:
    """Weather as text in which every third temperature and every fifth time is no number."""
    path = scratch_path(spark, "csv")
    raw = b.raw_weather(spark, sf).withColumn("n", F.col("dt"))
    damaged = raw.select(
        F.when(F.col("n") % 5 == 0, "yesterday").otherwise(F.col("dt").cast("string")).alias("dt"),
        F.when(F.col("n") % 3 == 0, "mild").otherwise(F.col("temp").cast("string")).alias("temp"),
        "pressure",
    )
    writers.write_table(damaged, path, "csv", header=True)
    return path


DAMAGED = {"dt": "bigint", "temp": "double", "pressure": "int"}


@query()
def unreadable_cells(spark, sf):
    """Cells that a typed read turns into nulls, per column."""
    return readers.unreadable_cells(spark, _damaged_csv(spark, sf), DAMAGED)


@query()
def ingest_report(spark, sf):
    """The same counts, taken while the typed table is written."""
    typed, seen = readers.read_csv_counted(spark, _damaged_csv(spark, sf), DAMAGED)
    writers.settle(typed, "typed")
    return readers.counted_cells(spark, seen, DAMAGED)
