"""Trends, effects and distributions of trips."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.functions.calendar import is_off_day
from dockflow.functions.timeparts import weekday_name
from dockflow.operators.flows import at_station, exclude_round_trips
from dockflow.operators.quality import first_per_key
from dockflow.spec import TripSpec

WEATHER_MEANS = ["avg_temperature", "avg_precipitation", "avg_wind_speed"]


def monthly_trips(trips: DataFrame, station=None, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips per month, of one start station or of all, with a ``yyyy-MM`` label."""
    if station is not None:
        trips = at_station(trips, station, "start", spec)
    start = F.col(spec.started_at)
    grouped = trips.groupBy(F.year(start).alias("year"), F.month(start).alias("month"))
    return grouped.agg(F.count(spec.ride).alias("trip_count")).withColumn(
        "year_month", F.format_string("%d-%02d", "year", "month")
    )


def daily_trips(trips: DataFrame, station=None, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips per day, of one start station or of the whole system."""
    if station is not None:
        trips = at_station(trips, station, "start", spec)
    return trips.groupBy(F.to_date(spec.started_at).alias("date")).agg(F.count(spec.ride).alias("trip_count"))


def holiday_effect(daily: DataFrame, flag: Column | None = None) -> DataFrame:
    """Mean daily trips on off-days and on other days. ``flag`` replaces the off-day rule."""
    flag = is_off_day(F.col("date")) if flag is None else flag
    return daily.groupBy(flag.alias("is_holiday")).agg(F.avg("trip_count").alias("average_trip_count"))


def daily_trips_weather(daily: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily trips with the day's weather; days missing on either side drop out."""
    return daily.join(weather, "date")


def weather_correlation(daily: DataFrame, nulls: str = "zero", columns: Sequence[str] = WEATHER_MEANS) -> DataFrame:
    """Pearson correlation of daily trips with each weather mean.

    ``nulls="zero"`` reads a missing mean as 0, as ``DataFrame.stat.corr`` does; ``"skip"`` leaves the day out. A
    column that does not vary has no correlation, null.
    """
    if nulls not in ("zero", "skip"):
        raise ValueError("nulls is 'zero' or 'skip'")

    def value(name: str) -> Column:
        c = F.col(name).cast("double")
        return F.coalesce(c, F.lit(0.0)) if nulls == "zero" else c

    def pearson(x: Column, y: Column) -> Column:
        # the built-in corr divides by the spreads and stops on 0 in ANSI mode
        spread = F.stddev_pop(F.when(y.isNotNull(), x)) * F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), spread)

    return daily.agg(*[pearson(value("trip_count"), value(c)).alias(f"corr_{c}") for c in columns])


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, the null group included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))


def _by_hour_and_weekday(trips: DataFrame, spec: TripSpec) -> DataFrame:
    start = F.col(spec.started_at)
    return trips.groupBy(F.hour(start).alias("hour"), F.weekday(start).alias("_day")).agg(
        F.count(F.lit(1)).alias("count")
    )


def hour_by_weekday(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips per hour of day and weekday."""
    return _by_hour_and_weekday(trips, spec).select(
        "hour", weekday_name(F.col("_day")).alias("day_of_week"), "count"
    )


def usage_matrix(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Weekdays by hours. The hours are listed, so no extra pass looks for them; a cell without trips is null."""
    start = F.col(spec.started_at)
    keyed = trips.select(F.weekday(start).alias("_day"), F.hour(start).alias("hour"))
    wide = keyed.groupBy("_day").pivot("hour", list(range(24))).agg(F.count(F.lit(1)))
    hours = [F.col(f"`{h}`").alias(f"h{h:02d}") for h in range(24)]
    return wide.select(weekday_name(F.col("_day")).alias("day_of_week"), *hours)


def weekday_weekend_by_hour(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips per hour on weekdays and weekends: totals, and per kind of day the mean over its five or two weekdays."""
    weekend = F.col("_day") >= 5
    totals = _by_hour_and_weekday(trips, spec).groupBy("hour").agg(
        F.sum(F.when(weekend, 0).otherwise(F.col("count"))).alias("weekday_count"),
        F.sum(F.when(weekend, F.col("count")).otherwise(0)).alias("weekend_count"),
    )
    return totals.withColumns(
        {
            "weekday_per_day": F.col("weekday_count") / 5,
            "weekend_per_day": F.col("weekend_count") / 2,
        }
    )


def od_counts(trips: DataFrame, station=None, side: str = "start", spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips between a station and each other one; of every station when none is given.

    ``side`` is the end of the trip at the station: ``"start"`` counts destinations, ``"end"`` counts origins.
    """
    end = spec.side(side)
    if station is not None:
        trips = at_station(trips, station, side, spec)
    return (
        exclude_round_trips(trips, spec)
        .groupBy(F.col(end.station).alias("station"), F.col(end.partner).alias("partner"))
        .agg(F.count(spec.ride).alias("trip_count"))
    )


def top_partners(od: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` busiest partners of each station, ties by name."""
    return first_per_key(od, ["station"], [F.desc("trip_count"), F.asc("partner")], n)


def top_partner(od: DataFrame) -> DataFrame:
    """The busiest partner of each station."""
    return top_partners(od, 1)


def station_coordinates(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """One position per station: the mean of its arrivals' positions."""
    known = F.col(spec.end_lat).isNotNull() & F.col(spec.end_lng).isNotNull()
    return (
        trips.where(F.col(spec.end_station).isNotNull() & known)
        .groupBy(F.col(spec.end_station).alias("station"))
        .agg(F.avg(spec.end_lat).alias("lat"), F.avg(spec.end_lng).alias("lng"))
    )


def latest_rows(df: DataFrame, ts: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The ``n`` latest rows. Each task keeps its own ``n``, so there is no full sort."""
    return df.orderBy(F.desc(ts), *[F.desc(t) for t in ties]).limit(n)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows, for a look at a table."""
    return df.limit(n)
