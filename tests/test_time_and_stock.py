from datetime import date, datetime

from pyspark.sql import functions as F

from dockflow.functions import calendar as cal
from dockflow.functions.stock import is_full, stock_status
from dockflow.functions.timeparts import epoch_to_text, epoch_to_ts, model_time, with_duration, with_time_parts
from tests.data import rows, trips

# The federal holidays of 2021 to 2023.
HOLIDAYS = [
    "2021-01-01",
    "2021-01-18",
    "2021-02-15",
    "2021-05-31",
    "2021-07-04",
    "2021-09-06",
    "2021-10-11",
    "2021-11-11",
    "2021-11-25",
    "2021-12-25",
    "2022-01-01",
    "2022-01-17",
    "2022-02-21",
    "2022-05-30",
    "2022-07-04",
    "2022-09-05",
    "2022-10-10",
    "2022-11-11",
    "2022-11-24",
    "2022-12-25",
    "2023-01-01",
    "2023-01-16",
    "2023-02-20",
    "2023-05-29",
    "2023-07-04",
    "2023-09-04",
    "2023-10-09",
    "2023-11-11",
    "2023-11-23",
    "2023-12-25",
]


def test_holiday_rules_give_the_published_dates(spark):
    days = cal.calendar(spark, "2021-01-01", "2023-12-31").where("is_holiday")
    assert sorted(str(r.date) for r in days.collect()) == HOLIDAYS


def test_off_day_reproduces_a_limited_calendar(spark):
    days = cal.calendar(spark, "2020-12-01", "2024-01-31").select(
        "date", cal.is_off_day(F.col("date"), cal.OFF_DAY_WEEKENDS, cal.OFF_DAY_YEARS).alias("off")
    )
    off = {r.date for r in days.where("off").collect()}
    assert date(2021, 7, 4) in off and date(2023, 3, 26) in off
    assert date(2023, 4, 1) not in off and date(2020, 12, 25) not in off and date(2024, 1, 1) not in off
    assert date(2023, 12, 25) in off


def test_extended_holidays(spark):
    named = {r.date: r.holiday_name for r in cal.calendar(spark, "2020-01-01", "2023-12-31", "extended").collect()}
    assert named[date(2021, 6, 19)] == "Juneteenth" and named[date(2020, 6, 19)] is None
    assert named[date(2021, 7, 5)] == "Independence Day (Observed)"
    assert named[date(2021, 12, 24)] == "Christmas Day (Observed)"
    assert named[date(2022, 11, 8)] == "Election Day"
    assert named[date(2021, 2, 12)] == "Lincoln's Birthday"


def test_missing_date_is_no_holiday(spark):
    df = spark.createDataFrame([(None,), (date(2022, 7, 4),)], "date date")
    assert sorted(r[1] for r in cal.flag_holidays(df, "date").collect()) == [False, True]
    table = spark.createDataFrame([(date(2022, 7, 4), "x"), (date(2022, 7, 4), "y")], "date date, holiday_name string")
    assert sorted(r.is_holiday for r in cal.flag_holidays(df, "date", table).collect()) == [False, True]


def test_epochs_across_the_clock_change(spark):
    df = spark.createDataFrame([(1667712600,), (1667716200,)], "t long")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        back = epoch_to_ts(df, "t").select(F.unix_timestamp("t").alias("t"))
        assert rows(back) == [(1667712600,), (1667716200,)]
        texts = {r[0] for r in epoch_to_text(df, "t").collect()}
        assert texts == {"2022-11-06 01:30:00"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_neither_wraps_nor_hides_its_sign(spark):
    got = {r.ride_id: (r.duration_seconds, r.trip_duration) for r in with_duration(trips(spark), "started_at", "ended_at").collect()}
    assert got["r1"] == (1200, "00:20:00")
    assert got["r6"] == (-3600, "-01:00:00")
    assert got["r7"] == (93605, "26:00:05")
    assert got["r4"] == (None, None)


def test_time_parts(spark):
    r = with_time_parts(trips(spark).where("ride_id = 'r1'"), "started_at", "s_").first()
    assert (r.s_date, r.s_year_month, r.s_year, r.s_month, r.s_hour, r.s_hour_label, r.s_day_of_week) == (
        date(2022, 1, 31),
        202201,
        2022,
        1,
        23,
        "23:00",
        "Mon",
    )
    one = spark.createDataFrame([(date(2022, 1, 31), "23:00")], "d date, h string")
    assert one.select(model_time(F.col("d"), F.col("h"))).first()[0] == datetime(2022, 1, 31, 23)


def test_stock_tiers_at_their_edges(spark):
    cases = [
        (50, "Enough"), (49, "Some"), (25, "Some"), (24, "Few"), (10, "Few"), (9, "Very Few"),
        (1, "Very Few"), (0, "No Bikes"), (-3, "No Bikes"), (120, "Enough"),
    ]
    df = spark.createDataFrame([(b,) for b, _ in cases], "b int")
    got = df.select("b", stock_status(F.col("b"), F.lit(100)).alias("m"), is_full(F.col("b"), F.lit(100)).alias("f"))
    by_bikes = {r.b: r for r in got.collect()}
    assert all(by_bikes[b].m.startswith(start) for b, start in cases)
    assert [b for b, r in by_bikes.items() if r.f] == [120]
    null = spark.createDataFrame([(None,)], "b int").select(stock_status(F.col("b"), F.lit(100)))
    assert null.first()[0] is None
