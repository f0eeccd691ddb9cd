"""Append streams of station status and live weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dockflow.functions.timeparts import epoch_to_ts
from dockflow.sources.readers import clean_names, stream_table
from dockflow.spec import LIVE_WEATHER_RAW, STATUS_RAW

TRIGGER = "30 minutes"


def status_events(raw: DataFrame) -> DataFrame:
    """Status reports with their time as a timestamp. Works on a batch and on a stream."""
    return epoch_to_ts(raw, "last_reported")


def weather_events(raw: DataFrame) -> DataFrame:
    """Live weather with its time as a timestamp and plain column names."""
    return epoch_to_ts(clean_names(raw), "dt")


def feed_schema(spark: SparkSession, src: str, contract: str | StructType, fmt: str = "parquet") -> StructType:
    """The contract's columns and all others that the feed's table has now; just the contract's while it has no files."""
    fields = StructType.fromDDL(contract).fields if isinstance(contract, str) else contract.fields
    known = {f.name for f in fields}
    try:
        found = spark.read.format(fmt).load(src).schema.fields
    except AnalysisException:
        found = []
    return StructType([*fields, *(f for f in found if f.name not in known)])


def drop_repeats(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within ``delay`` of the first.

    The watermark lets Spark forget keys, so state stays as large as ``delay`` worth of reports. A row older than the
    watermark is dropped as late and counted in the query's progress.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys, ts])


def append_stream(
    df: DataFrame, dst: str, checkpoint: str, name: str, trigger: str | None = TRIGGER, fmt: str = "parquet"
) -> StreamingQuery:
    """Start an append query into a table folder.

    ``trigger`` is the micro-batch interval; ``None`` works off what is there now and stops. The checkpoint folder
    must not hold the output folder, and both belong on storage every executor sees: a restarted query goes on from
    there without loss or repeats.
    """
    writer = df.writeStream.outputMode("append").format(fmt).queryName(name).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start(dst)


def stream_status(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    dedup_within: str | None = None,
    schema=STATUS_RAW,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    extras: bool = True,
) -> StreamingQuery:
    """Station status from a growing table to an append table, optionally without repeated reports.

    Columns of the feed that the contract does not know are kept, as far as the source's files have them when the stream
    starts, unless ``extras`` is off.
    """
    schema = feed_schema(spark, src, schema, fmt) if extras else schema
    rows = status_events(stream_table(spark, src, schema, fmt, files_per_batch))
    if dedup_within:
        rows = drop_repeats(rows, ["station_id"], "last_reported", dedup_within)
    return append_stream(rows, dst, checkpoint, "station_status", trigger, fmt)


def stream_weather(
    spark: SparkSession,
    src: str,
    dst: str,
    checkpoint: str,
    trigger: str | None = TRIGGER,
    dedup_within: str | None = None,
    schema=LIVE_WEATHER_RAW,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    extras: bool = True,
) -> StreamingQuery:
    """Live weather, likewise."""
    schema = feed_schema(spark, src, schema, fmt) if extras else schema
    rows = weather_events(stream_table(spark, src, schema, fmt, files_per_batch))
    if dedup_within:
        rows = drop_repeats(rows, [], "dt", dedup_within)
    return append_stream(rows, dst, checkpoint, "live_weather", trigger, fmt)


def stream_progress(query: StreamingQuery) -> dict:
    """What the query is doing, and the counts of its last micro-batch."""
    last = query.lastProgress
    return {
        "status": query.status,
        "batch": last["batchId"] if last else None,
        "input_rows": last["numInputRows"] if last else 0,
        "late_rows": sum(s["numRowsDroppedByWatermark"] for s in last["stateOperators"]) if last else 0,
    }
