"""The driver's test tables seen as trips, weather, status and forecasts.

Each binding is a projection or join over whole tables, so Spark prunes and pushes down through it.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockflow.functions.timeparts import hour_of, model_time
from dockflow.operators import flows, forecast, inventory
from dockflow.sources.writers import settle
from dockflow.spec import TripSpec

# Evaluation scheme for thirty days of events.
SCHEME = {"initial": timedelta(days=14), "horizon": timedelta(days=4), "period": timedelta(days=2)}
ORDERS = TripSpec(ride="o_orderkey", start_station="o_orderpriority", started_at="o_orderdate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are arrivals and views are departures at a station."""
    events = table(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view"))
    arrives = F.col("event_type") == "click"
    station = F.col("user_id") % 10
    return events.select(
        F.col("event_id").alias("ride_id"),
        F.when(arrives, station).alias("end_station_name"),
        F.when(arrives, F.col("ts")).alias("ended_at"),
        F.when(~arrives, station).alias("start_station_name"),
        F.when(~arrives, F.col("ts")).alias("started_at"),
    )


def all_event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a departure."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ride_id"),
        (F.col("user_id") % 10).alias("start_station_name"),
        F.col("ts").alias("started_at"),
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors are weather readings; snow and rain have gaps."""
    value = F.col("value")
    return table(spark, sf_dir, "events").where(F.col("event_type") == "error").select(
        F.col("ts").alias("dt"),
        value.alias("temp"),
        (value - 2).alias("feels_like"),
        (1000 + F.col("event_id") % 40).cast("int").alias("pressure"),
        (F.col("user_id") % 100).cast("int").alias("humidity"),
        (value / 10).alias("wind_speed"),
        ((F.col("event_id") % 10) / 10).alias("pop"),
        F.when(F.col("event_id") % 4 != 0, F.greatest(40 - value, F.lit(0.0))).alias("snow_1h"),
        F.when(value > 80, value - 80).alias("rain_1h"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases are status reports."""
    return table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select(
        "event_id",
        (F.col("user_id") % 10).alias("station"),
        F.col("ts").alias("last_reported"),
        F.col("value").cast("int").alias("num_bikes_available"),
    )


def raw_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status reports as the live feed sends them, with epoch seconds."""
    return status(spark, sf_dir).select(
        F.col("station").cast("string").alias("station_id"),
        F.unix_timestamp(F.col("last_reported").cast("timestamp")).alias("last_reported"),
        "num_bikes_available",
        F.when(F.col("num_bikes_available") > 0, "active").otherwise("out_of_service").alias("station_status"),
    )


def raw_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live weather as the feed sends it: epoch seconds and dotted names."""
    return weather(spark, sf_dir).select(
        F.unix_timestamp(F.col("dt").cast("timestamp")).alias("dt"),
        "temp",
        "pressure",
        "humidity",
        "wind_speed",
        "pop",
        F.col("rain_1h").alias("rain.1h"),
    )


def od_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each line item is a trip from the customer's nation to the supplier's."""
    nation = table(spark, sf_dir, "nation")
    source = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("start_station_name"))
    target = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("end_station_name"))
    customers = table(spark, sf_dir, "customer").join(source, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), "start_station_name", F.col("c_mktsegment").alias("member_casual")
    )
    suppliers = table(spark, sf_dir, "supplier").join(target, "s_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), "end_station_name"
    )
    orders = table(spark, sf_dir, "orders").join(customers, "o_custkey").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").alias("started_at"),
        "start_station_name",
        "member_casual",
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(suppliers, "l_suppkey")
        .join(orders, "l_orderkey")
        .select(
            F.col("l_orderkey").alias("ride_id"),
            F.col("l_returnflag").alias("rideable_type"),
            "member_casual",
            "start_station_name",
            "end_station_name",
            "started_at",
            F.col("l_shipdate").alias("ended_at"),
            F.col("l_extendedprice").alias("end_lat"),
            F.col("l_discount").alias("end_lng"),
        )
    )


def flow_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Net change per station and hour, without weather: the panel the forecasters learn from.

    Evaluation reads it from several sides, so it is written once, as the silver table is.
    """
    hourly = flows.hourly_net_flow(event_trips(spark, sf_dir))
    frame = hourly.select(
        "station",
        model_time(F.col("start_date_column"), F.col("start_hour")).alias("ds"),
        F.col("net_change").alias("y"),
    )
    return settle(frame, "panel")


def silver(spark: SparkSession, sf_dir: str, station=None) -> DataFrame:
    """Hourly flows with complete weather, the hourly means written first."""
    means = settle(flows.weather_by_hour(weather(spark, sf_dir)), "weather-hours")
    return flows.silver_from_hourly(event_trips(spark, sf_dir), means, station=station)


def weather_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model rows with complete weather."""
    return flows.to_model_frame(silver(spark, sf_dir))


def fitted_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profile forecast of every station and hour of the panel."""
    frame = flow_frame(spark, sf_dir)
    fitted = forecast.apply_profile(frame.select("station", "ds"), forecast.seasonal_profile(frame))
    return fitted.select("station", "ds", "yhat")


def hourly_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last report of each station and hour."""
    reports = status(spark, sf_dir).withColumn("ds", hour_of(F.col("last_reported")))
    return inventory.latest_as_of(reports, ["station", "ds"], "last_reported", ["num_bikes_available"]).drop(
        "last_reported"
    )
