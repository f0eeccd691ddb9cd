"""Silver kept up to date by a stream: hourly flows and weather with late rows, day folders replaced as they change."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dockflow.functions.timeparts import hour_label
from dockflow.operators.flows import complete_rows
from dockflow.session import scratch_path
from dockflow.sources.readers import read_table
from dockflow.spec import HOURLY_READINGS, TripSpec

_VALUES = ["num_rides_in", "num_rides_out", "rows", *[f"{part}_{c}" for c in HOURLY_READINGS for part in ("sum", "n")]]


def _no_readings() -> list[Column]:
    return [F.lit(None).cast("double").alias(c) for c in HOURLY_READINGS]


def _movements(trips: DataFrame, spec: TripSpec, delay: str) -> DataFrame:
    """Each trip as an arrival and a departure, with a watermark on when they happened."""
    counted = F.col(spec.ride).isNotNull().cast("long")
    ends = [
        F.struct(
            F.col(side.station).cast("string").alias("station"),
            F.col(side.at).cast("timestamp").alias("at"),
            F.when(F.lit(arrives), counted).otherwise(0).alias("rides_in"),
            F.when(F.lit(arrives), 0).otherwise(counted).alias("rides_out"),
        )
        for side, arrives in ((spec.side("end"), True), (spec.side("start"), False))
    ]
    rows = trips.select(F.inline(F.array(*ends))).where(F.col("station").isNotNull() & F.col("at").isNotNull())
    return rows.select(F.lit("flow").alias("kind"), "station", "at", "rides_in", "rides_out", *_no_readings()).withWatermark("at", delay)


def _readings(weather: DataFrame, ts: str, delay: str) -> DataFrame:
    none = F.lit(None).cast("long")
    rows = weather.where(F.col(ts).isNotNull()).select(
        F.lit("weather").alias("kind"),
        F.lit("").alias("station"),
        F.col(ts).cast("timestamp").alias("at"),
        none.alias("rides_in"),
        none.alias("rides_out"),
        *[F.col(c).cast("double").alias(c) for c in HOURLY_READINGS],
    )
    return rows.withWatermark("at", delay)


def hourly_totals(trips: DataFrame, weather: DataFrame, spec: TripSpec = TripSpec(), ts: str = "dt", delay: str = "1 day") -> DataFrame:
    """Totals per clock hour of both streams: rides by station, and sums and counts of every weather reading.

    Each stream has its own watermark and the older one holds, so a feed that runs ahead does not make the other late.
    State is one row per station and hour of the last ``delay``. A row older than the watermark is dropped.
    """
    both = _movements(trips, spec, delay).unionByName(_readings(weather, ts, delay))
    # counted before the aggregate, so that rows it drops as late can be told from the difference
    both = both.observe("movements", F.count(F.lit(1)).alias("rows"))
    sums = [F.coalesce(F.sum(f"rides_{way}"), F.lit(0)).alias(f"num_rides_{way}") for way in ("in", "out")]
    for c in HOURLY_READINGS:
        sums += [F.sum(c).alias(f"sum_{c}"), F.count(c).alias(f"n_{c}")]
    hourly = both.groupBy(F.window("at", "1 hour"), "kind", "station").agg(*sums, F.count(F.lit(1)).alias("rows"))
    return hourly.select(F.col("window.start").alias("hour"), "kind", "station", *_VALUES)


def _schema(columns: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns.schema.fields)


def latest_totals(spark: SparkSession, base: str, days: list | None = None) -> DataFrame:
    """The newest totals of every hour, of some days or all, from the log of changes that batches left."""
    log = spark.read.option("basePath", f"{base}/hours").parquet(f"{base}/hours/batch=*")
    if days is not None:
        log = log.where(F.col("day").isin(days))
    newest = F.max_by(F.struct(*_VALUES), "batch").alias("v")
    return log.groupBy("day", "hour", "kind", "station").agg(newest).select("day", "hour", "kind", "station", "v.*")


def silver_of(totals: DataFrame, station: str = "string") -> DataFrame:
    """The silver rows of hourly totals: flows of hours whose weather is complete."""
    flows = totals.where("kind = 'flow'").select(F.col("station").cast(station).alias("station"), F.col("hour").alias("_hour"), "num_rides_in", "num_rides_out")
    means = totals.where("kind = 'weather'").select(
        F.col("hour").alias("_hour"), *[F.try_divide(F.col(f"sum_{c}"), F.col(f"n_{c}")).alias(f"avg_{c}") for c in HOURLY_READINGS]
    )
    averages = [f"avg_{c}" for c in HOURLY_READINGS]
    date, label = F.to_date("_hour"), hour_label(F.col("_hour"))
    return flows.join(complete_rows(means, averages), "_hour").select(
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


def replace_days(base: str, silver: str, station: str = "string") -> Callable[[DataFrame, int], None]:
    """A sink for ``foreachBatch``: log the batch's totals, then rebuild the day folders of ``silver`` that they touch.

    The totals of batch n go to a folder of their own, which a repeated batch n replaces, and days are rebuilt from the
    log of all batches up to n. So a batch that is repeated after a failure, wherever that came, leaves the same tables.
    """

    def write(totals: DataFrame, batch: int) -> None:
        spark = totals.sparkSession
        folder = f"{base}/hours/batch={batch}"
        totals.withColumn("day", F.to_date("hour")).write.mode("overwrite").partitionBy("day").parquet(folder)
        written = totals.schema.add("day", "date")
        days = [r.day for r in spark.read.schema(written).parquet(folder).select("day").distinct().collect()]
        if days:
            rows = silver_of(latest_totals(spark, base, days).where(F.col("day").isNotNull()), station)
            balanced = rows.hint("rebalance", "start_date_column")
            balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("start_date_column").parquet(silver)

    return write


def stream_silver(
    trips: DataFrame,
    weather: DataFrame,
    base: str,
    silver: str,
    checkpoint: str,
    spec: TripSpec = TripSpec(),
    ts: str = "dt",
    delay: str = "1 day",
    trigger: str | None = None,
    station: str = "string",
) -> StreamingQuery:
    """Start a query that keeps the silver table current from streams of trips and weather.

    ``base`` holds the log of hourly totals, ``silver`` the table by day. ``trigger`` is the micro-batch interval;
    ``None`` works off what is there and stops. A query started again on its checkpoint goes on where it stopped.
    """
    writer = hourly_totals(trips, weather, spec, ts, delay).writeStream.outputMode("update").queryName("silver")
    writer = writer.option("checkpointLocation", checkpoint).foreachBatch(replace_days(base, silver, station))
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def read_movements(query: StreamingQuery) -> int:
    """Arrivals, departures and weather readings that a finished query's batches have read."""
    return sum(p.observedMetrics["movements"]["rows"] for p in query.recentProgress if "movements" in p.observedMetrics)


def counted_movements(spark: SparkSession, base: str) -> int:
    """Arrivals, departures and readings that are in the totals; what was read beyond them came too late."""
    return latest_totals(spark, base).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def read_silver(spark: SparkSession, silver: str) -> DataFrame:
    return read_table(spark, silver)


def work_folders(spark: SparkSession, name: str = "silver") -> tuple[str, str, str]:
    """New folders for the log, the table and the checkpoint, below the shared scratch folder."""
    return tuple(scratch_path(spark, f"{name}-{part}") for part in ("log", "table", "checkpoint"))
