"""From raw files to gold, on a small city."""

import dataclasses
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest

from dockflow.operators import evaluation, forecast
from dockflow.plans import pipeline
from dockflow.spec import LIVE_WEATHER_RAW, STATUS_RAW
from tests.data import rows

START = datetime(2022, 1, 3)
DAYS = 26
NOW = START + timedelta(days=DAYS, hours=10, minutes=30)
DAY = timedelta(days=1)


def write_inputs(spark, base):
    rng = np.random.default_rng(3)
    trips = []
    for h in range(DAYS * 24):
        hour = START + timedelta(hours=h)
        for i in range(4 if 7 <= hour.hour <= 20 else 1):
            a, b = ("North", "South") if hour.hour < 12 else ("South", "North")
            start = hour + timedelta(minutes=int(rng.integers(0, 40)))
            trips.append((f"r{h}-{i}", "classic_bike", start, start + timedelta(minutes=12), a, "1", b, "2", 1.0, 1.0, 2.0, 2.0, "member"))
    columns = (
        "ride_id rideable_type started_at ended_at start_station_name start_station_id end_station_name "
        "end_station_id start_lat start_lng end_lat end_lng member_casual"
    ).split()
    pdf = pd.DataFrame(trips, columns=columns)
    (base / "trips").mkdir()
    for month, part in pdf.groupby(pdf.started_at.dt.strftime("%Y%m")):
        part.to_csv(base / "trips" / f"{month}.csv", index=False)
    epochs = [int((START + timedelta(hours=h) - datetime(1970, 1, 1)).total_seconds()) for h in range(DAYS * 24)]
    weather = pd.DataFrame({"dt": epochs + epochs[:5]})
    for name in ("temp", "feels_like", "wind_speed", "pop", "snow.1h", "rain.1h"):
        weather[name] = rng.random(len(weather)).round(3)
    for name in ("pressure", "humidity", "clouds", "visibility", "wind_deg"):
        weather[name] = rng.integers(1, 100, len(weather))
    weather["main"] = "Clear"
    (base / "weather").mkdir()
    weather.to_csv(base / "weather" / "all.csv", index=False)
    now = int((NOW - datetime(1970, 1, 1)).total_seconds())
    status = [
        (sid, now - 1800 * k, bikes, "active") for sid, bikes in (("id-n", 40), ("id-s", 2)) for k in range(0, 14)
    ]
    spark.createDataFrame(status, STATUS_RAW).write.parquet(str(base / "status"))
    live = [(now - 1800 - 3600 * k, 5.0 + k, 1010, 50, 3.0, 0.2, None) for k in range(0, 8)]
    spark.createDataFrame(live, LIVE_WEATHER_RAW).write.parquet(str(base / "live"))


@pytest.fixture(scope="module")
def config(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("city")
    write_inputs(spark, base)
    design = forecast.Design(changepoints=1, seasonalities=((7.0, 2), (1.0, 2)), extra=None)
    setting = {**forecast.DEFAULT_SETTING, "seasonality_mode": "additive"}
    made = pipeline.PipelineConfig(
        trips_csv=str(base / "trips"),
        weather_csv=str(base / "weather"),
        status=str(base / "status"),
        live_weather=str(base / "live"),
        base=str(base / "lake"),
        database="dock_city",
        now=NOW,
        grid=[setting, {**setting, "seasonality_prior_scale": 1e-6}],
        design=design,
        initial=14 * DAY,
        horizon=4 * DAY,
        stations={"id-n": "North", "id-s": "South"},
    )
    pipeline.run_pipeline(spark, made)
    yield made
    spark.sql("USE default")


def table(spark, config, name):
    return spark.table(config.name(name))


def test_bronze_and_silver(spark, config):
    assert table(spark, config, "bronze_weather").count() == DAYS * 24
    trips = table(spark, config, "bronze_trips")
    silver = table(spark, config, "silver_weather_trip")
    assert silver.agg({"num_rides_out": "sum"}).first()[0] == trips.count()
    assert silver.where("net_change != num_rides_in - num_rides_out").count() == 0


def test_models_are_scored_registered_and_staged(spark, config):
    metrics = table(spark, config, "model_metrics")
    assert metrics.count() == 4 and metrics.where("mae is null").count() == 0
    best = evaluation.best_params(metrics, ["setting_id"], ["station"])
    assert {r.setting_id for r in best.collect()} == {0}
    staged = table(spark, config, "staged_models")
    assert rows(staged, "station", "stage", "model_version") == [("North", "Staging", 1), ("South", "Staging", 1)]


def test_every_setting_has_all_measures_and_unused_rows_are_counted(spark, config):
    metrics = table(spark, config, "model_metrics")
    for name in evaluation.METRICS:
        assert metrics.where(f"{name} is null").count() == 0, name
    chosen = table(spark, config, "chosen_metrics")
    assert rows(chosen, "station", "mdape") == rows(metrics.where("setting_id = 0"), "station", "mdape")
    held_out = evaluation.forecast_metrics(table(spark, config, "cv_predictions"), ["station"]).collect()
    for r in held_out:
        want = chosen.where(f"station = '{r.station}'").first()
        assert [r[m] for m in evaluation.METRICS] == pytest.approx([want[m] for m in evaluation.METRICS])
    assert {r.left_out for r in table(spark, config, "training_rows").collect()} == {0}
    gap = spark.createDataFrame([("A", 1.0, 2.0), ("A", None, 2.0), ("A", 1.0, None), ("B", None, None)], "station string, y double, avg_temp double")
    design = forecast.Design(regressors=("avg_temp",))
    assert rows(forecast.training_rows(gap, ["station"], design)) == [("A", 3, 2), ("B", 1, 1)]
    compared = table(spark, config, "stage_difference").collect()
    assert all(r.low <= r.difference <= r.high for r in compared)


def test_gold_and_outlook(spark, config):
    gold = table(spark, config, "gold_data")
    # Reports from 06:30 to 10:30 fall into five clock hours.
    assert gold.groupBy("station").count().where("count = 5").count() == 2
    assert gold.where("num_bikes_available_y not in (40, 2)").count() == 0
    assert gold.where("residual != num_bikes_available_x - num_bikes_available_y").count() == 0
    # Mornings move bikes from North to South.
    outlook = table(spark, config, "gold_outlook")
    assert outlook.groupBy("station").count().where("count = 4").count() == 2
    first = {r.station: r for r in outlook.where("ds = '2022-01-29 11:00:00'").collect()}
    assert first["North"].num_bikes_available < 40 and first["South"].num_bikes_available > 2
    assert outlook.where("status_message is null").count() == 0


def test_stage_tables(spark, config):
    assert {r.stage for r in table(spark, config, "stage_comparison").collect()} >= {"Staging"}
    assert table(spark, config, "stage_residuals").count() > 0
    assert table(spark, config, "explore_monthly_trips").count() == 1


def test_explore_results(spark, config):
    results = pipeline.run_explore(spark, config, "North")
    assert all(df.count() > 0 for df in results.values())
    assert rows(results["top_destinations"], "partner") == [("South",)]


def test_second_training_promotes_a_new_version(spark, config):
    again = dataclasses.replace(config, now=NOW + DAY, promote=True)
    pipeline.run_train(spark, again)
    pipeline.run_app(spark, again)
    staged = table(spark, config, "staged_models")
    assert rows(staged, "station", "stage", "model_version") == [
        ("North", "Production", 2),
        ("North", "Staging", 1),
        ("South", "Production", 2),
        ("South", "Staging", 1),
    ]


def test_period_limits_silver(spark, config):
    whole = table(spark, config, "silver_weather_trip").where("start_date_column >= '2022-01-10'")
    expected = rows(whole.where("start_date_column < '2022-01-12'"))
    limited = dataclasses.replace(config, start="2022-01-10", end="2022-01-12")
    before = rows(table(spark, config, "silver_weather_trip"))
    pipeline.run_silver(spark, limited)
    after = table(spark, config, "silver_weather_trip")
    assert rows(after.where("start_date_column >= '2022-01-10' and start_date_column < '2022-01-12'")) == expected
    # what lies outside the period stays
    assert rows(after) == before


def test_ingest_report_counts_what_was_lost(spark, config):
    report = {(r.source, r.column): r for r in table(spark, config, "ingest_report").collect()}
    assert report["weather", None].left_out == 5
    assert report["trips", "ride_id"].rows == table(spark, config, "bronze_trips").count()
    assert all(r.unreadable == 0 for r in report.values())


def test_silent_and_unmapped_stations_and_capacity(spark, config, tmp_path):
    now = int((NOW - datetime(1970, 1, 1)).total_seconds())
    status = [("id-n", now - 600, 20, "active"), ("id-s", now - 90000, 2, "active"), ("ghost", now - 60, 1, "active"), ("ghost", now - 30, 1, "active")]
    spark.createDataFrame(status, STATUS_RAW).write.parquet(str(tmp_path / "status"))
    info = [("id-n", "North", 20), ("id-s", "South", None)]
    spark.createDataFrame(info, "station_id string, station_name string, capacity int").write.parquet(str(tmp_path / "info"))
    other = dataclasses.replace(config, status=str(tmp_path / "status"), station_info=str(tmp_path / "info"), stations={})
    pipeline.run_app(spark, other)
    assert rows(table(spark, other, "unmapped_stations")) == [("ghost", 2)]
    outlook = table(spark, other, "gold_outlook").where("stage = 'Staging'")
    assert outlook.where("ds <= '2022-01-29 10:30:00'").count() == 0
    hours = {r.station: r["count"] for r in outlook.groupBy("station").count().collect()}
    assert hours == {"North": 4, "South": 4}
    assert rows(outlook.select("station", "capacity").distinct()) == [("North", 20), ("South", 105)]
    assert "ghost" in {r.station for r in table(spark, other, "current_stock").collect()}


def test_interrupted_training_is_repeated_safely(spark, config, monkeypatch):
    later = dataclasses.replace(config, now=NOW + 2 * DAY)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(pipeline.registry, "register_numbered", fail)
        with pytest.raises(RuntimeError):
            pipeline.run_train(spark, later)
    pipeline.run_train(spark, later)
    pipeline.run_train(spark, later)
    kept = table(spark, config, "models_registered")
    assert kept.groupBy("model_name", "version").count().where("count > 1").count() == 0
    log = pipeline.registry.open_registry(spark, later.path("registry")).where("event = 'register'")
    assert log.groupBy("model_name", "version").count().where("count > 1").count() == 0


def test_extra_columns_reach_bronze(spark, config, tmp_path):
    (tmp_path / "trips").mkdir()
    (tmp_path / "trips" / "a.csv").write_text("ride_id,started_at,helmet\n1,2022-01-03 10:00:00,yes\n2,not a time,no\n")
    other = dataclasses.replace(config, trips_csv=str(tmp_path / "trips"), base=str(tmp_path / "lake"), database="dock_extra", extras=True, mixed_headers=True)
    spark.sql("CREATE DATABASE IF NOT EXISTS dock_extra")
    pipeline.run_bronze(spark, other)
    assert rows(table(spark, other, "bronze_trips"), "helmet") == [("no",), ("yes",)]
    bad = table(spark, other, "ingest_report").where("source = 'trips' and column = 'started_at'").first()
    assert (bad.rows, bad.unreadable) == (2, 1)


def test_bad_period_is_refused(spark, config):
    with pytest.raises(ValueError):
        pipeline.run_silver(spark, dataclasses.replace(config, start="2022-02-01", end="2022-01-01"))
