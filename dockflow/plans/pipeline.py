"""The end-to-end run: raw files to bronze, silver, model and gold tables.

Each stage reads tables and writes tables on shared storage, so a lost executor costs the tasks it ran and a failed
stage can be run again alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.timeparts import epoch_to_ts, hour_of
from dockflow.operators import evaluation, explore, flows, forecast, inventory, quality, registry
from dockflow.operators.series import forward_fill
from dockflow.sources.ingest import ingest_new_files, read_ingested
from dockflow.sources.readers import clean_names, counted_cells, read_csv_counted, read_table, union_sources
from dockflow.sources.writers import balance, cluster_by, ensure_database, publish, register, settle
from dockflow.spec import DEFAULT_CAPACITY, TRIPS_RAW, WEATHER_RAW, TripSpec
from dockflow.streaming.streams import status_events, weather_events


@dataclass(frozen=True)
class PipelineConfig:
    """Where the inputs and tables are and what to run.

    ``station_info`` is a table of station_id, station_name and capacity; ``stations`` names stations without one.
    ``extras`` keeps columns of the raw files that the contract does not know. With ``incremental`` a run reads only raw
    files that came since the last one, and silver is rebuilt for the days they touch.
    """

    trips_csv: str
    weather_csv: str
    status: str
    live_weather: str
    base: str
    database: str
    now: datetime
    mixed_headers: bool = False
    start: str | None = None
    end: str | None = None
    fmt: str = "parquet"
    grid: Sequence[Mapping] = field(default_factory=lambda: [dict(forecast.DEFAULT_SETTING)])
    design: forecast.Design = forecast.FULL_DESIGN
    initial: timedelta = forecast.INITIAL
    horizon: timedelta = forecast.HORIZON
    period: timedelta | None = None
    hours: int = 4
    promote: bool = False
    stations: Mapping[str, str] = field(default_factory=dict)
    station_info: str | None = None
    extras: bool = True
    incremental: bool = False

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"

    def name(self, table: str) -> str:
        return f"`{self.database}`.{table}"


def _save(df: DataFrame, config: PipelineConfig, table: str, by: Sequence[str] = (), parts: bool = False) -> DataFrame:
    """Write a table, register it, and read it back: later stages start from files, not from this plan."""
    publish(df, config.path(table), config.name(table), config.fmt, by, parts)
    return read_table(df.sparkSession, config.path(table), config.fmt)


def run_bronze(spark: SparkSession, config: PipelineConfig) -> None:
    """Raw files to typed tables: weather unique by time, trips clustered by station and time.

    ``ingest_report`` counts, per file kind and column, the cells that could not be read and became null, and the
    weather rows left out because their time was missing, unreadable or repeated.
    """
    options = {"mixed_headers": config.mixed_headers, "extras": config.extras}
    # the text is read once, into typed tables; what cannot be read is counted on the way
    typed, seen = {}, {}
    for source, path, contract in (("trips", config.trips_csv, TRIPS_RAW), ("weather", config.weather_csv, WEATHER_RAW)):
        rows, seen[source] = read_csv_counted(spark, path, contract, **options)
        typed[source] = settle(clean_names(rows), f"typed-{source}")
    raw, trips = epoch_to_ts(typed["weather"], "dt"), typed["trips"]
    weather = quality.dedup(raw.where(F.col("dt").isNotNull()), ["dt"])
    kept = _save(cluster_by(weather, "dt"), config, "bronze_weather")
    _save(
        cluster_by(trips, "start_station_name", spread=["started_at", "ride_id"]),
        config,
        "bronze_trips",
    )
    cells = [counted_cells(spark, seen[source], contract).withColumn("source", F.lit(source)) for source, contract in (("trips", TRIPS_RAW), ("weather", WEATHER_RAW))]
    left = raw.agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"source": F.lit("weather"), "column": F.lit(None).cast("string"), "unreadable": F.lit(0).cast("long"), "left_out": F.col("rows") - F.lit(kept.count())}
    )
    _save(union_sources([*cells, left]).select("source", "column", "rows", "unreadable", "left_out"), config, "ingest_report")


def run_ingest(spark: SparkSession, config: PipelineConfig) -> list:
    """Raw files that came since the last run to the bronze tables; returns the days that their rows touch.

    Trips are appended, each batch in its folder. Weather is appended likewise and made unique by time from there, which
    is small work. ``ingest_log`` lists the batches of this run.
    """
    sources = {"trips": (config.trips_csv, TRIPS_RAW, "bronze_trips"), "weather": (config.weather_csv, WEATHER_RAW, "ingested_weather")}
    batches = {}
    for source, (path, contract, name) in sources.items():
        ledger = config.path(f"_ledger/{source}")
        batches[source] = ingest_new_files(spark, path, config.path(name), ledger, contract, config.extras)
        if batches[source]:
            register(spark, config.path(name), config.name(name), "parquet", ["batch"])
    log = [(source, b["batch"], b["files"], b["bytes"]) for source, found in batches.items() for b in found]
    _save(spark.createDataFrame(log, "source string, batch long, files long, bytes long"), config, "ingest_log")
    days = []
    if batches["trips"]:
        new = read_ingested(spark, config.path("bronze_trips"), [b["batch"] for b in batches["trips"]])
        days += [new.select(F.to_date(c).alias("day")) for c in ("started_at", "ended_at")]
    if batches["weather"]:
        whole = epoch_to_ts(clean_names(read_ingested(spark, config.path("ingested_weather"))), "dt").where(F.col("dt").isNotNull())
        _save(cluster_by(quality.dedup(whole, ["dt"]), "dt"), config, "bronze_weather")
        new = read_ingested(spark, config.path("ingested_weather"), [b["batch"] for b in batches["weather"]])
        days.append(epoch_to_ts(new.select("dt"), "dt").select(F.to_date("dt").alias("day")))
    return [r.day for r in union_sources(days).where("day is not null").distinct().collect()] if days else []


def run_silver(spark: SparkSession, config: PipelineConfig, days: Sequence[date] | None = None) -> None:
    """Hourly flows with weather, a folder per day. A configured period limits what is read and what is replaced.

    So do ``days``, where they are given: only their folders are rebuilt, from all trips that touch them.
    """
    period = (config.start, config.end)
    trips = flows.touching_period(read_table(spark, config.path("bronze_trips"), config.fmt), *period)
    if days is not None:
        spec = TripSpec()
        trips = trips.where(F.to_date(spec.started_at).isin(list(days)) | F.to_date(spec.ended_at).isin(list(days)))
    weather = flows.in_period(read_table(spark, config.path("bronze_weather"), config.fmt), "dt", *period)
    means = _save(flows.weather_by_hour(weather), config, "weather_hours")
    silver = flows.in_period(flows.silver_from_hourly(trips, means), "start_date_column", *period)
    day = ["start_date_column"]
    if days is not None:
        silver = silver.where(F.col("start_date_column").isin(list(days)))
    _save(balance(silver, by=day), config, "silver_weather_trip", day, parts=any(period) or days is not None)


def run_explore(spark: SparkSession, config: PipelineConfig, station: str | None = None) -> dict[str, DataFrame]:
    """The exploratory results, lazily; each is small once it runs."""
    trips = read_table(spark, config.path("bronze_trips"), config.fmt)
    weather = read_table(spark, config.path("bronze_weather"), config.fmt)
    spec = TripSpec()
    daily = explore.daily_trips(trips)
    by_weather = explore.daily_trips_weather(daily, flows.daily_weather(weather))
    return {
        "monthly_trips": explore.monthly_trips(trips, station).orderBy("year", "month"),
        "daily_trips": daily.orderBy("date"),
        "holiday_effect": explore.holiday_effect(daily),
        "weather_correlation": explore.weather_correlation(by_weather),
        "bike_types": explore.value_counts(trips, spec.bike_type).orderBy(spec.bike_type),
        "rider_types": explore.value_counts(trips, spec.rider_type).orderBy(spec.rider_type),
        "hour_by_weekday": explore.hour_by_weekday(trips).orderBy("hour", "day_of_week"),
        "usage_matrix": explore.usage_matrix(trips),
        "weekday_weekend": explore.weekday_weekend_by_hour(trips).orderBy("hour"),
        "top_destinations": explore.top_partners(explore.od_counts(trips, station, "start")),
        "top_origins": explore.top_partners(explore.od_counts(trips, station, "end")),
        "coordinates": explore.station_coordinates(trips),
    }


def save_explore(spark: SparkSession, config: PipelineConfig) -> None:
    """The exploratory results of all stations as tables named ``explore_*``."""
    for name, result in run_explore(spark, config).items():
        _save(result, config, f"explore_{name}")


def run_train(spark: SparkSession, config: PipelineConfig) -> None:
    """Fit and evaluate every setting for every station; register, keep and stage each station's best model.

    ``model_metrics`` has all measures of every setting, ``training_rows`` the rows that could not be used.
    """
    frame = flows.to_model_frame(read_table(spark, config.path("silver_weather_trip"), config.fmt))
    _save(forecast.training_rows(frame, ["station"], config.design), config, "training_rows")
    scheme = {"initial": config.initial, "horizon": config.horizon, "period": config.period}
    fitted = forecast.fit_panel(frame, ["station"], config.grid, config.design, folds=True, **scheme)
    models = _save(fitted, config, "models")
    setting = ["setting_id", *forecast.SETTING_COLUMNS]
    predicted = forecast.score_settings(frame, models, ["station"], config.design, **scheme)
    # all measures of every setting come from two pipelined passes; only the chosen setting's predictions are stored
    metrics = _save(evaluation.forecast_metrics(predicted, ["station", *setting]), config, "model_metrics")
    best = evaluation.best_params(metrics, setting, ["station"]).select("station", "setting_id")
    chosen_models = models.join(best, ["station", "setting_id"], "left_semi")
    of_chosen = forecast.cv_predict(frame, chosen_models, ["station"], config.design, **scheme)
    columns = ["station", *setting, "fold", "ds", "y", "yhat", "yhat_lower", "yhat_upper"]
    _save(of_chosen.select(columns), config, "cv_predictions")
    measured = metrics.select("station", "setting_id", *evaluation.METRICS)
    scores = _save(measured.join(best, ["station", "setting_id"], "left_semi"), config, "chosen_metrics")
    chosen = (
        models.where(F.col("fold") == forecast.ALL_HISTORY)
        .drop("fold", "train_rows")
        .join(best, ["station", "setting_id"], "left_semi")
        .join(scores, ["station", "setting_id"], "left")
        .withColumns(
            {
                "model_name": F.concat(F.col("station"), F.lit("_model")),
                "params": F.create_map(*[x for c in setting for x in (F.lit(c), F.col(c).cast("string"))]),
                "metrics": F.create_map(*[x for c in evaluation.METRICS for x in (F.lit(c), F.col(c))]),
            }
        )
    )
    path = config.path("registry")
    registry.create_registry(spark, path)
    # a run is named by its time: repeated, it finds the same versions, replaces its own models and registers once
    earlier = registry.open_registry(spark, path).where(F.col("event_ts") < F.lit(config.now))
    numbered = registry.next_versions(earlier, chosen).withColumn("run_id", F.lit(config.now.strftime("%Y%m%dT%H%M%S%f")))
    latest = _save(numbered, config, "models_latest")
    _save(latest, config, "models_registered", ["run_id"], parts=True)
    registry.register_numbered(path, latest, config.now)
    stages = ["Staging", "Production"] if config.promote else ["Staging"]
    for step, stage in enumerate(stages, 1):
        registry.transition_stage(path, latest, stage, config.now + timedelta(seconds=step))


def staged_models(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """The model behind the latest version of every station in every stage."""
    versions = registry.latest_versions(registry.open_registry(spark, config.path("registry")))
    kept = read_table(spark, config.path("models_registered"), config.fmt)
    columns = ["seasonality_mode", "trend_coef", "season_coef", "lift_base", "lift_slope", "sigma", "drift", "knots", "_first", "_last"]
    return versions.join(kept, ["model_name", "version"]).select(
        "station", "stage", F.col("version").alias("model_version"), *columns
    )


def station_table(spark: SparkSession, config: PipelineConfig) -> DataFrame:
    """(station_id, station, capacity) of the known stations, one row each."""
    if config.station_info:
        info = read_table(spark, config.station_info, config.fmt)
        capacity = F.col("capacity") if "capacity" in info.columns else F.lit(None)
        info = info.select("station_id", F.col("station_name").alias("station"), capacity.cast("int").alias("capacity"))
    else:
        pairs = [(k, v, None) for k, v in config.stations.items()]
        info = spark.createDataFrame(pairs, "station_id string, station string, capacity int")
    return info.groupBy("station_id").agg(F.min("station").alias("station"), F.max("capacity").alias("capacity"))


def run_app(spark: SparkSession, config: PipelineConfig) -> None:
    """Current state, gold (the last hours' forecast stock beside the observed) and the outlook of the next hours.

    Reports of stations that are not in the station table keep their id as the name and are counted in
    ``unmapped_stations``. The outlook covers the hours after ``now`` for every station with a model, also one that
    has been silent: its stock is its last report, whenever that was.
    """
    known = _save(station_table(spark, config), config, "stations")
    reports = status_events(read_table(spark, config.status, config.fmt)).join(known, "station_id", "left")
    unmapped = reports.where(F.col("station").isNull()).groupBy("station_id").agg(F.count(F.lit(1)).alias("reports"))
    _save(unmapped, config, "unmapped_stations")
    reports = reports.withColumn("station", F.coalesce("station", "station_id")).drop("capacity")
    docks = known.groupBy("station").agg(F.max("capacity").alias("capacity"))
    status = flows.as_of(reports, "last_reported", config.now)
    weather = weather_events(read_table(spark, config.live_weather, config.fmt))
    stock = inventory.latest_as_of(status, ["station"], "last_reported", ["num_bikes_available"])
    hourly = _save(_hourly_state(status, weather, config), config, "recent_hours")
    models = _save(staged_models(spark, config), config, "staged_models")
    series = ["stage", "model_version"]

    def with_docks(df: DataFrame) -> DataFrame:
        return df.join(docks, "station", "left").withColumn("capacity", F.coalesce("capacity", F.lit(DEFAULT_CAPACITY)))

    predicted = forecast.predict(hourly.drop("num_bikes_available"), models, ["station"], config.design)
    earlier = flows.as_of(status, "last_reported", config.now - timedelta(hours=config.hours))
    before = inventory.latest_as_of(earlier, ["station"], "last_reported", ["num_bikes_available"])
    gold = inventory.gold_inventory(with_docks(predicted), hourly, before, extra=series, capacity="capacity")
    gold = _save(gold, config, "gold_data")
    _save(evaluation.compare_stages(gold), config, "stage_comparison")
    _save(evaluation.stage_difference(gold), config, "stage_difference")
    _save(evaluation.residual_distribution(gold, ["stage"]), config, "stage_residuals")

    hours = _save(_coming_weather(weather, config), config, "coming_hours")
    stations = models.select("station").distinct().withColumn("ds", F.explode(_hours_after(config)))
    coming = forecast.predict(stations.join(hours, "ds"), models, ["station"], config.design)
    now_stock = with_docks(coming).join(stock.select("station", F.col("num_bikes_available").alias("_stock")), "station", "left")
    outlook = inventory.with_status(
        inventory.running_inventory(now_stock, F.col("_stock"), ["station", *series], block="month"), capacity="capacity"
    )
    _save(
        outlook.select("station", *series, "ds", "yhat", "num_bikes_available", "capacity", "status_message", "is_full"),
        config,
        "gold_outlook",
    )
    _save(stock, config, "current_stock")


def _hours_after(config: PipelineConfig) -> Column:
    first = config.now.replace(minute=0, second=0, microsecond=0) + timedelta(hours=1)
    return F.array(*[F.lit(first + timedelta(hours=h)) for h in range(config.hours)])


def _coming_weather(weather: DataFrame, config: PipelineConfig) -> DataFrame:
    """The regressors of the coming hours: those of the newest hour known by then, forecast hours included."""
    hourly = inventory.live_hourly_weather(weather).withColumnRenamed("date_hour", "ds")
    hourly = hourly.where(F.col("ds") >= F.lit(config.now - timedelta(days=1)))
    ahead = weather.sparkSession.range(1).select(F.explode(_hours_after(config)).alias("ds"), F.lit(True).alias("coming"))
    joined = hourly.join(ahead, "ds", "full").withColumn("place", F.lit(0))
    filled = forward_fill(joined, ["place"], "ds", list(config.design.regressors), block="month")
    return filled.where(F.col("coming")).select("ds", *config.design.regressors)


def _hourly_state(status: DataFrame, weather: DataFrame, config: PipelineConfig) -> DataFrame:
    """The last report of each station and recent hour with its weather.

    One row per hour, as in the history the models learned from: an hourly change must be counted once per hour
    however often a station reports.
    """
    seen = inventory.inference_frame(status, weather, config.now, config.hours, by="station", within=timedelta(days=1))
    values = ["num_bikes_available", *config.design.regressors]
    return (
        inventory.latest_as_of(seen.withColumn("_hour", hour_of(F.col("ds"))), ["station", "_hour"], "ds", values)
        .drop("ds")
        .withColumnRenamed("_hour", "ds")
    )


def run_pipeline(spark: SparkSession, config: PipelineConfig) -> None:
    """All stages in order; a failure in one stops the run."""
    ensure_database(spark, config.database)
    if config.incremental:
        run_silver(spark, config, run_ingest(spark, config))
    else:
        run_bronze(spark, config)
        run_silver(spark, config)
    for stage in (save_explore, run_train, run_app):
        stage(spark, config)
