from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from dockflow.functions.calendar import calendar_of
from dockflow.operators import flows
from tests.data import TRIP_DDL, at, rows, trips

JOIN_COLUMNS = flows.FLOW_COLUMNS


def test_net_flow_counts_both_ends(spark):
    got = {(r.station, str(r.start_date_column), r.start_hour): r for r in flows.hourly_net_flow(trips(spark)).collect()}
    assert got["B", "2022-02-01", "00:00"].num_rides_in == 1
    assert got["A", "2022-01-31", "23:00"].net_change == -1
    both = got["A", "2022-02-01", "08:00"]
    assert (both.num_rides_in, both.num_rides_out, both.net_change) == (2, 1, 1)
    # A ride without an id makes its hour appear but is not counted.
    assert got["B", "2022-02-01", "09:00"].num_rides_in == 0
    assert got["A", "2022-02-01", "09:00"].num_rides_out == 1
    # Missing stations and times belong to no hour.
    assert all(k[0] is not None for k in got)


def test_inbound_and_outbound(spark):
    inbound = rows(flows.hourly_inbound(trips(spark)), "station", "end_date_column", "end_hour", "num_rides_in")
    assert ("C", date(2022, 2, 2), "12:00", 1) in inbound
    assert ("B", date(2022, 2, 1), "09:00", 0) in inbound
    outbound = rows(flows.hourly_outbound(trips(spark)), "station", "start_date_column", "start_hour", "num_rides_out")
    assert ("A", date(2022, 1, 31), "23:00", 1) in outbound


def test_single_pass_equals_outer_join(spark):
    a, b = flows.hourly_net_flow(trips(spark)), flows.hourly_flows_joined(trips(spark))
    assert rows(a, *JOIN_COLUMNS) == rows(b, *JOIN_COLUMNS)


moments = st.datetimes(at("2022-03-26 00:00:00"), at("2022-03-28 00:00:00"))
trip_rows = st.lists(
    st.tuples(
        st.one_of(st.none(), st.text("xyz", min_size=1, max_size=3)),
        st.one_of(st.none(), st.sampled_from("ABC")),
        st.one_of(st.none(), st.sampled_from("ABC")),
        st.one_of(st.none(), moments),
        st.one_of(st.none(), moments),
    ),
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=trip_rows)
def test_property_single_pass_equals_outer_join(spark, data):
    df = spark.createDataFrame([(*r, None, None, None, None) for r in data], TRIP_DDL)
    single = rows(flows.hourly_net_flow(df), *JOIN_COLUMNS)
    assert single == rows(flows.hourly_flows_joined(df), *JOIN_COLUMNS)
    arrivals = sum(1 for r in data if r[0] and r[2] and r[4])
    assert sum(r[3] for r in single) == arrivals


def test_one_station_is_its_part_of_all(spark):
    whole = flows.hourly_net_flow(trips(spark))
    assert rows(flows.hourly_net_flow(trips(spark), station="A")) == rows(whole.where("station = 'A'"))
    silver = flows.silver_hourly(trips(spark), weather(spark))
    assert rows(flows.silver_hourly(trips(spark), weather(spark), station="B")) == rows(silver.where("station = 'B'"))


def test_densify_adds_only_quiet_hours(spark):
    dense = flows.hourly_net_flow(trips(spark), densify=True)
    kept = dense.where("num_rides_in + num_rides_out > 0")
    plain = flows.hourly_net_flow(trips(spark)).where("num_rides_in + num_rides_out > 0")
    assert rows(kept, *JOIN_COLUMNS) == rows(plain, *JOIN_COLUMNS)
    # A runs from 31 January 23:00 to 3 February 13:00, both hours included.
    assert dense.where("station = 'A'").count() == 63


def weather(spark):
    data = [
        (at("2022-02-01 08:00:00"), 10.0, 0.5, None),
        (at("2022-02-01 08:30:00"), 20.0, None, 1.0),
        (at("2022-02-01 00:00:00"), 5.0, None, 1.0),
        (at("2022-02-02 12:00:00"), float("nan"), 0.1, 0.1),
    ]
    base = spark.createDataFrame(data, "dt timestamp, temp double, snow_1h double, rain_1h double")
    extra = {c: base.temp * 0 + 1 for c in ("feels_like", "pressure", "humidity", "wind_speed", "pop")}
    return base.withColumns(extra)


def test_silver_keeps_hours_with_complete_weather(spark):
    silver = flows.silver_hourly(trips(spark), weather(spark))
    got = rows(silver, "station", "start_hour", "weather_hour", "avg_temp", "avg_snow_1h", "avg_rain_1h")
    assert got == [("A", "08:00", "08:00", 15.0, 0.5, 1.0), ("B", "08:00", "08:00", 15.0, 0.5, 1.0)]


def test_silver_is_the_complete_part_of_the_left_join(spark):
    joined = flows.enrich_with_weather(flows.hourly_net_flow(trips(spark)), flows.hourly_weather(weather(spark)))
    silver = flows.silver_hourly(trips(spark), weather(spark))
    assert joined.count() == flows.hourly_net_flow(trips(spark)).count()
    assert rows(flows.complete_rows(joined), *silver.columns) == rows(silver)
    assert rows(joined.dropna(), *silver.columns) == rows(silver)


def test_model_frame(spark):
    frame = flows.to_model_frame(flows.silver_hourly(trips(spark), weather(spark)))
    assert rows(frame, "station", "ds", "y") == [("A", at("2022-02-01 08:00:00"), 1), ("B", at("2022-02-01 08:00:00"), -1)]
    assert frame.columns[:2] == ["station", "ds"] and frame.columns[-1] == "y" and len(frame.columns) == 10


def test_station_filters(spark):
    df = trips(spark)
    assert rows(flows.at_station(df, "C", "end"), "ride_id") == [("r6",), ("r8",), ("r9",)]
    assert rows(flows.touching_station(df, "C"), "ride_id") == [("r6",), ("r7",), ("r8",), ("r9",)]
    assert "r2" not in {r[0] for r in rows(flows.exclude_round_trips(df), "ride_id")}
    assert flows.exclude_round_trips(df).count() == 6
    with pytest.raises(ValueError):
        flows.at_station(df, "A", "middle")


def test_time_filters(spark):
    df = trips(spark)
    now = at("2022-02-02 11:00:00")
    assert rows(flows.as_of(df, "started_at", now).where("started_at >= '2022-02-02'"), "ride_id") == [("r6",), ("r7",)]
    assert rows(flows.recent(df, "started_at", now, 1), "ride_id") == [("r6",), ("r7",), ("r9",)]
    assert rows(flows.at_hour(df, "ended_at", "2022-02-02 12:00:00"), "ride_id") == [("r9",)]
    assert rows(flows.in_period(df, "started_at", "2022-02-02", "2022-02-03"), "ride_id") == [("r6",), ("r7",), ("r9",)]
    with pytest.raises(ValueError):
        flows.in_period(df, "started_at", "2022-02-02", "2022-02-01")


def test_period_of_trips_covers_its_hours(spark):
    period = ("2022-02-01", "2022-02-02")
    whole = flows.in_period(flows.hourly_net_flow(trips(spark)), "start_date_column", *period)
    part = flows.hourly_net_flow(flows.touching_period(trips(spark), *period))
    assert rows(flows.in_period(part, "start_date_column", *period)) == rows(whole)
    assert flows.touching_period(trips(spark)).count() == len(rows(trips(spark)))


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "trips")
    trips(spark).write.parquet(path)
    df = flows.at_station(flows.recent(spark.read.parquet(path), "started_at", at("2022-02-02 11:00:00"), 1), "A")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = df.select("ride_id")._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "EqualTo(start_station_name,A)" in pushed and "GreaterThanOrEqual(started_at" in pushed
    assert "rideable_type" not in plan[plan.index("ReadSchema") :]


def test_a_wrong_date_stops_densifying(spark):
    early = trips(spark).limit(1).select(*[F.lit(at("0001-01-01 00:00:00")).alias(c) if c == "started_at" else F.col(c) for c in trips(spark).columns])
    with pytest.raises(Exception, match="no rides for years"):
        flows.hourly_net_flow(trips(spark).unionByName(early), densify=True).collect()
    with pytest.raises(Exception, match="dates from 0001"):
        calendar_of(trips(spark).unionByName(early), "started_at").collect()
