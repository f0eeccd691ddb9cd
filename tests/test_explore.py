import pytest
from pyspark.sql import functions as F

from dockflow.operators import explore, flows, quality
from tests.data import rows, trips


def test_monthly_and_daily(spark):
    assert rows(explore.monthly_trips(trips(spark), "A"), "year_month", "trip_count") == [("2022-01", 1), ("2022-02", 3)]
    daily = {str(r.date): r.trip_count for r in explore.daily_trips(trips(spark)).collect()}
    # The null day holds the trip without a start time; the ride without an id is not counted.
    assert daily == {"2022-01-31": 1, "2022-02-01": 3, "2022-02-02": 3, "None": 1}


@pytest.mark.parametrize("column", ["rideable_type", "member_casual", "end_station_name"])
def test_value_counts_add_up_to_the_rows(spark, column):
    counted = explore.value_counts(trips(spark), column)
    assert counted.agg(F.sum("count")).first()[0] == trips(spark).count()


def test_hour_by_weekday_agrees_with_matrix_and_totals(spark):
    df = trips(spark).where("started_at is not null")
    cells = {(r.day_of_week, r.hour): r["count"] for r in explore.hour_by_weekday(df).collect()}
    assert cells["Tue", 8] == 2 and cells["Mon", 23] == 1
    for row in explore.usage_matrix(df).collect():
        for h in range(24):
            assert row[f"h{h:02d}"] == cells.get((row.day_of_week, h))
    totals = {r.hour: (r.weekday_count, r.weekend_count) for r in explore.weekday_weekend_by_hour(df).collect()}
    assert totals[8] == (2, 0) and sum(a + b for a, b in totals.values()) == df.count()


def test_partners(spark):
    out = explore.od_counts(trips(spark), "A", "start")
    # A ride without an id makes no count, a round trip and an open end make no pair; B and C tie by count.
    assert rows(out, "partner", "trip_count") == [("B", 1), ("C", 1)]
    assert rows(explore.top_partner(out), "partner") == [("B",)]
    into = explore.od_counts(trips(spark), "A", "end")
    assert rows(into, "station", "partner", "trip_count") == [("A", "B", 1), ("A", "C", 1)]
    assert explore.top_partners(explore.od_counts(trips(spark)), 1).count() == 3


def test_coordinates_skip_missing_positions(spark):
    got = {r.station: (r.lat, r.lng) for r in explore.station_coordinates(trips(spark)).collect()}
    assert got["B"] == (2.0, 3.0) and got["A"] == (4.0, 5.0)


def test_holiday_effect(spark):
    daily = spark.createDataFrame(
        [("2022-07-04", 10), ("2022-07-05", 4), ("2022-07-06", 6), ("2022-07-09", 20)], "date string, trip_count long"
    ).withColumn("date", F.to_date("date"))
    assert rows(explore.holiday_effect(daily)) == [(False, 5.0), (True, 15.0)]


def test_correlation_null_modes(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (2, None), (3, 2.0), (4, 9.0)], "trip_count long, avg_temperature double"
    )
    zero = explore.weather_correlation(df, "zero", ["avg_temperature"]).first()[0]
    skip = explore.weather_correlation(df, "skip", ["avg_temperature"]).first()[0]
    assert zero == pytest.approx(df.stat.corr("trip_count", "avg_temperature"))
    assert skip == pytest.approx(df.select(F.corr("trip_count", "avg_temperature")).first()[0])
    assert abs(zero - skip) > 1e-3
    with pytest.raises(ValueError):
        explore.weather_correlation(df, "drop")


def test_latest_rows_break_ties(spark):
    df = spark.createDataFrame([(1, 5), (2, 7), (3, 7), (4, 6)], "id int, t int")
    assert [r.id for r in explore.latest_rows(df, "t", 3, ["id"]).collect()] == [3, 2, 4]
    assert explore.first_rows(df, 2).count() == 2


def test_quality(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (1, "b", 2), (2, None, 1), (None, "c", 1), (None, "d", 1)], "k int, v string, o int"
    )
    assert rows(quality.null_profile(df)) == [(2, 1, 0)]
    assert rows(quality.duplicate_check(df, ["k"])) == [(5, 3, True)]
    assert rows(quality.duplicate_check(df, ["k", "v"])) == [(5, 5, False)]
    assert rows(quality.duplicate_check(df.where("k > 5"), ["k"])) == [(0, 0, False)]
    assert rows(quality.dedup(df, ["k"], ["o", "v"])) == [(1, "b", 2), (2, None, 1), (None, "c", 1)]
    assert rows(quality.dedup(df, ["k"])) == [(1, "a", 3), (2, None, 1), (None, "c", 1)]
    assert quality.unique_values(df, ["o"]).count() == 3
    assert quality.dedup(df, ["k"]).groupBy("k").count().where("count > 1").count() == 0


def test_rank_filter_runs_before_the_shuffle(spark):
    plan = quality.dedup(spark.range(10).withColumn("v", F.col("id") % 2), ["v"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "Partial" in plan


def test_fill_and_complete(spark):
    df = spark.createDataFrame([(1, None, 1.0), (None, 2, float("nan"))], "num_rides_in int, num_rides_out int, w double")
    assert rows(flows.fill_flows(df), "num_rides_in", "num_rides_out") == [(0, 2), (1, 0)]
    assert flows.complete_rows(flows.fill_flows(df)).count() == 1
