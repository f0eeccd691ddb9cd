from datetime import timedelta

from dockflow.operators import evaluation, inventory
from tests.data import at, rows

NOW = at("2022-02-01 12:30:00")


def status(spark):
    data = [
        ("s1", at("2022-02-01 08:00:00"), 5),
        ("s1", at("2022-02-01 10:10:00"), 7),
        ("s1", at("2022-02-01 12:00:00"), 9),
        ("s1", at("2022-02-01 12:00:00"), 9),
        ("s1", at("2022-02-01 13:00:00"), 99),
        ("s2", at("2022-01-31 08:00:00"), 3),
    ]
    return spark.createDataFrame(data, "station_id string, last_reported timestamp, num_bikes_available int")


def weather(spark):
    data = [
        (at("2022-02-01 10:00:00"), 1.0, 1000, 50, 3.0, 0.1, None),
        (at("2022-02-01 10:30:00"), 3.0, 1002, 60, 5.0, 0.3, 0.4),
    ]
    return spark.createDataFrame(
        data, "dt timestamp, temp double, pressure int, humidity int, wind_speed double, pop double, rain_1h double"
    )


def test_latest_as_of(spark):
    got = inventory.latest_as_of(status(spark), ["station_id"], "last_reported", ["num_bikes_available"], NOW)
    assert rows(got, "station_id", "num_bikes_available") == [("s1", 9), ("s2", 3)]
    empty = inventory.latest_as_of(status(spark), ["station_id"], "last_reported", ["num_bikes_available"], "2020-01-01")
    assert empty.count() == 0


def test_inference_frame(spark):
    frame = inventory.inference_frame(status(spark), weather(spark), NOW, 4)
    got = rows(frame, "station_id", "ds", "num_bikes_available", "avg_temp", "avg_rain_1h", "avg_snow_1h")
    # 12:00 has no weather of its own and takes that of the report before; reports older than four hours are gone.
    assert got[0] == ("s1", at("2022-02-01 10:10:00"), 7, 2.0, 0.4, 0.0)
    assert got[1] == got[2] == ("s1", at("2022-02-01 12:00:00"), 9, 2.0, 0.4, 0.0)
    assert {r[0] for r in got} == {"s1"}


def test_gold_pairs_forecast_with_observation(spark):
    hours = [at("2022-02-01 10:00:00") + timedelta(hours=h) for h in range(3)]
    forecast = spark.createDataFrame(
        [("s", "Staging", hours[0], 1.2), ("s", "Staging", hours[1], -3.5), ("s", "Production", hours[0], 60.0)],
        "station string, stage string, ds timestamp, yhat double",
    )
    observed = spark.createDataFrame(
        [("s", hours[0], 50), ("s", hours[1], 40), ("s", hours[2], 1)],
        "station string, ds timestamp, num_bikes_available int",
    )
    stock = spark.createDataFrame([("s", 50)], "station string, num_bikes_available int")
    gold = inventory.gold_inventory(forecast, observed, stock, extra=["stage"])
    got = rows(gold, "stage", "ds", "num_bikes_available_x", "num_bikes_available_y", "residual", "is_full")
    assert got == [
        ("Production", hours[0], 110, 50, 60, True),
        ("Staging", hours[0], 51, 50, 1, False),
        ("Staging", hours[1], 47, 40, 7, False),
    ]
    stages = {r.stage: r for r in evaluation.compare_stages(gold).collect()}
    assert stages["Staging"].mae == 4.0 and stages["Production"].bias == 60.0
