"""Hourly flows per station, hourly weather, and the silver table that joins them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dockflow.functions.timeparts import hour_label, hour_of, model_time
from dockflow.spec import HOURLY_READINGS, REGRESSORS, TripSpec

FLOW_COLUMNS = ["station", "start_date_column", "start_hour", "num_rides_in", "num_rides_out", "net_change"]


# -- filters ------------------------------------------------------------------------------------------------------


def at_station(trips: DataFrame, station, side: str = "start", spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips that start (or end) at a station."""
    return trips.where(F.col(spec.side(side).station) == station)


def touching_station(trips: DataFrame, station, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips that start or end at a station."""
    return trips.where((F.col(spec.start_station) == station) | (F.col(spec.end_station) == station))


def exclude_round_trips(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips between two different, known stations."""
    return trips.where(F.col(spec.start_station) != F.col(spec.end_station))


def in_period(df: DataFrame, ts: str, start=None, end=None) -> DataFrame:
    """Rows from ``start`` (included) to ``end`` (excluded); either may be open."""
    return df.where(_within(df, ts, start, end))


def touching_period(trips: DataFrame, start=None, end=None, spec: TripSpec = TripSpec()) -> DataFrame:
    """Trips that start or end in a period: all that can count in its hours."""
    return trips.where(_within(trips, spec.started_at, start, end) | _within(trips, spec.ended_at, start, end))


def _within(df: DataFrame, ts: str, start, end) -> Column:
    if start is not None and end is not None and str(end) <= str(start):
        raise ValueError(f"the period ends ({end}) before it starts ({start})")
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(ts) >= _moment(df, ts, start))
    if end is not None:
        inside = inside & (F.col(ts) < _moment(df, ts, end))
    return inside


def _moment(df: DataFrame, ts: str, value) -> Column:
    """A literal of the column's own type: a cast on the column would keep the filter from the scan."""
    return F.lit(str(value)).cast(df.schema[ts].dataType)


def as_of(df: DataFrame, ts: str, now) -> DataFrame:
    """Rows up to and including ``now``."""
    return df.where(F.col(ts) <= _moment(df, ts, now))


def recent(df: DataFrame, ts: str, now, hours: int) -> DataFrame:
    """Rows of the last ``hours`` before ``now``, and any later."""
    return df.where(F.col(ts) >= _moment(df, ts, now) - F.expr(f"INTERVAL {int(hours)} HOURS"))


def at_hour(df: DataFrame, ts: str, hour) -> DataFrame:
    """Rows within one clock hour, as a range test that reaches the scan."""
    start = _moment(df, ts, hour)
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 HOUR")))


def fill_flows(flows: DataFrame) -> DataFrame:
    """Hours with movement one way only have no rides the other way."""
    return flows.fillna({"num_rides_in": 0, "num_rides_out": 0})


def complete_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows without a null or NaN in the given columns (all by default).

    One test per column instead of one over all: each can then move below a join on its own, and a left join whose
    right side must be present becomes an inner one.
    """
    kinds = dict(df.dtypes)
    for name in columns or df.columns:
        keep = F.col(name).isNotNull()
        if kinds[name] in ("double", "float"):
            keep = keep & ~F.isnan(name)
        df = df.where(keep)
    return df


# -- hourly counts ------------------------------------------------------------------------------------------------


def _split_hour(df: DataFrame, date: str, label: str) -> DataFrame:
    """Replace the hour key by its date and label; runs on groups, not on trips."""
    rest = [c for c in df.columns if c not in ("station", "_hour")]
    lead = ["station"] if "station" in df.columns else []
    return df.select(
        *lead, F.to_date("_hour").alias(date), hour_label(F.col("_hour")).alias(label), *rest
    )


def _hourly_rides(trips: DataFrame, spec: TripSpec, side: str, out: str) -> DataFrame:
    end = spec.side(side)
    return (
        trips.where(F.col(end.station).isNotNull())
        .groupBy(F.col(end.station).alias("station"), hour_of(F.col(end.at)).alias("_hour"))
        .agg(F.count(spec.ride).alias(out))
    )


def hourly_inbound(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Rides that end at each station in each hour; rides without an id are not counted."""
    return _split_hour(_hourly_rides(trips, spec, "end", "num_rides_in"), "end_date_column", "end_hour")


def hourly_outbound(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Rides that start at each station in each hour."""
    return _split_hour(_hourly_rides(trips, spec, "start", "num_rides_out"), "start_date_column", "start_hour")


def _net(flows: DataFrame) -> DataFrame:
    net = F.col("num_rides_in") - F.col("num_rides_out")
    return flows.withColumn("net_change", net).select(FLOW_COLUMNS)


def hourly_flows_joined(trips: DataFrame, spec: TripSpec = TripSpec()) -> DataFrame:
    """Inbound and outbound hourly counts brought together by a full outer join.

    Two passes over the trips. Kept for callers whose two sides are separate tables; :func:`hourly_net_flow` gives
    the same rows in one pass.
    """
    arrivals = _hourly_rides(trips, spec, "end", "num_rides_in").where(F.col("_hour").isNotNull())
    departures = _hourly_rides(trips, spec, "start", "num_rides_out").where(F.col("_hour").isNotNull())
    joined = fill_flows(arrivals.join(departures, ["station", "_hour"], "full_outer"))
    return _net(_split_hour(joined, "start_date_column", "start_hour"))


def hourly_net_flow(
    trips: DataFrame, spec: TripSpec = TripSpec(), densify: bool = False, station=None
) -> DataFrame:
    """Rides in, rides out and net change of every station and hour, in one pass over the trips.

    Each trip is an arrival at one station and a departure from another. Both are counted under one (station, hour)
    key, and partial sums are formed before the shuffle, so what moves is at most one row per station, hour and
    task however many trips a station has. ``densify`` adds hours without any ride; ``station`` keeps one station
    and reads its trips only.
    """
    flows = _flows_by_hour(trips, spec, station)
    if densify:
        flows = _with_quiet_hours(flows)
    return _net(_split_hour(flows, "start_date_column", "start_hour"))


def _flows_by_hour(trips: DataFrame, spec: TripSpec, station=None) -> DataFrame:
    if station is not None:
        trips = touching_station(trips, station, spec)
    here = F.col("station").isNotNull() if station is None else F.col("station") == station
    counted = F.col(spec.ride).isNotNull().cast("long")
    arrival, departure = (
        F.struct(F.col(side.station).alias("station"), F.col(side.at).alias("at"), F.lit(arrives).alias("arrives"))
        for side, arrives in ((spec.side("end"), True), (spec.side("start"), False))
    )
    return (
        trips.select(counted.alias("rides"), F.inline(F.array(arrival, departure)))
        .where(here & F.col("at").isNotNull())
        .groupBy("station", hour_of(F.col("at")).alias("_hour"))
        .agg(
            F.sum(F.when(F.col("arrives"), F.col("rides")).otherwise(0)).alias("num_rides_in"),
            F.sum(F.when(F.col("arrives"), 0).otherwise(F.col("rides"))).alias("num_rides_out"),
        )
    )


LONGEST_GAP_DAYS = 3660


def _with_quiet_hours(flows: DataFrame) -> DataFrame:
    """Add zero rows for the hours between a station's first and last ride that have none.

    Each row brings the quiet hours up to the next one. The window runs over hours, not trips, so a station's share of
    it is bounded by the length of the history. A gap of over ``LONGEST_GAP_DAYS`` is taken for a wrong date: it stops
    the run instead of becoming millions of hours.
    """
    step = F.expr("INTERVAL 1 HOUR")
    after = F.lead("_hour").over(W.partitionBy("station").orderBy("_hour"))
    too_far = F.datediff(after, F.col("_hour")) > LONGEST_GAP_DAYS
    message = F.concat(F.lit("no rides for years before "), after.cast("string"), F.lit("; remove wrong dates first"))
    following = F.when(too_far, F.raise_error(message)).otherwise(after)
    hours = F.sequence(F.col("_hour"), F.coalesce(F.col("_next") - step, F.col("_hour")), step)
    spread = flows.withColumn("_next", following).withColumn("_slot", F.explode(hours))

    def only_own(name: str) -> Column:
        return F.when(F.col("_slot") == F.col("_hour"), F.col(name)).otherwise(0).alias(name)

    return spread.select(
        "station", F.col("_slot").alias("_hour"), only_own("num_rides_in"), only_own("num_rides_out")
    )


# -- weather ------------------------------------------------------------------------------------------------------


def weather_by_hour(weather: DataFrame, ts: str = "dt", readings: Sequence[str] = HOURLY_READINGS) -> DataFrame:
    """Mean of each reading per clock hour ``hour_start``, missing readings left out."""
    means = [F.avg(c).alias(f"avg_{c}") for c in readings]
    return weather.groupBy(hour_of(F.col(ts)).alias("hour_start")).agg(*means)


def hourly_weather(weather: DataFrame, ts: str = "dt", readings: Sequence[str] = HOURLY_READINGS) -> DataFrame:
    """The same under a date and an hour label."""
    means = weather_by_hour(weather, ts, readings).withColumnRenamed("hour_start", "_hour")
    return _split_hour(means, "weather_date", "weather_hour")


def daily_weather(weather: DataFrame, ts: str = "dt") -> DataFrame:
    """Mean temperature, precipitation and wind speed per day."""
    return weather.groupBy(F.to_date(ts).alias("date")).agg(
        F.avg("temp").alias("avg_temperature"),
        F.avg("rain_1h").alias("avg_precipitation"),
        F.avg("wind_speed").alias("avg_wind_speed"),
    )


def enrich_with_weather(flows: DataFrame, weather: DataFrame) -> DataFrame:
    """Hourly flows with the hour's weather, flows without weather kept.

    No broadcast hint: hourly weather grows with the years covered. It is far smaller than the flows, and Spark
    broadcasts it while its size allows.
    """
    same_hour = (F.col("start_date_column") == F.col("weather_date")) & (
        F.col("start_hour") == F.col("weather_hour")
    )
    return flows.join(weather, same_hour, "left")


def silver_hourly(
    trips: DataFrame, weather: DataFrame, spec: TripSpec = TripSpec(), ts: str = "dt", station=None
) -> DataFrame:
    """Hourly flows with complete weather: the table models and reports read."""
    return silver_from_hourly(trips, weather_by_hour(weather, ts), spec, station)


def silver_from_hourly(trips: DataFrame, means: DataFrame, spec: TripSpec = TripSpec(), station=None) -> DataFrame:
    """Silver from trips and :func:`weather_by_hour`.

    Give the means as a written table when trips are many: its size is then known when the join is planned, and the
    flows are not shuffled a second time while it is small enough to broadcast.

    The result is the complete part of :func:`enrich_with_weather`, joined on the hour itself. Dates and labels are
    only made for the result: as join keys they would be formatted for every trip, in the null test that Spark
    derives from a join and moves down to the scan.
    """
    averages = [f"avg_{c}" for c in HOURLY_READINGS]
    complete = complete_rows(means, averages).withColumnRenamed("hour_start", "_hour")
    joined = _flows_by_hour(trips, spec, station).join(complete, "_hour")
    date, label = F.to_date("_hour"), hour_label(F.col("_hour"))
    return joined.select(
        "station",
        date.alias("start_date_column"),
        label.alias("start_hour"),
        "num_rides_in",
        "num_rides_out",
        (F.col("num_rides_in") - F.col("num_rides_out")).alias("net_change"),
        date.alias("weather_date"),
        label.alias("weather_hour"),
        *averages,
    )


def to_model_frame(silver: DataFrame) -> DataFrame:
    """One row per station and hour with the target ``y`` and the weather regressors."""
    return silver.select(
        "station",
        model_time(F.col("start_date_column"), F.col("start_hour")).alias("ds"),
        *REGRESSORS,
        F.col("net_change").alias("y"),
    )
