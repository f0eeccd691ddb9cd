"""Streams over folders that grow, compared with the same computation on a batch."""

from pyspark.sql import functions as F

from dockflow.operators import explore, quality
from dockflow.sources import readers, writers
from dockflow.spec import LIVE_WEATHER_RAW, STATUS_RAW
from dockflow.streaming import streams
from tests.data import rows

DAY = 86400


def send(spark, path, data, ddl=STATUS_RAW):
    writers.write_table(spark.createDataFrame(data, ddl).coalesce(1), path, mode="append")


def test_status_stream_equals_batch_and_survives_restart(spark, tmp_path):
    src, dst, check = (str(tmp_path / p) for p in ("src", "dst", "check"))
    first = [("s1", 100, 5, "active"), ("s1", 100, 5, "active"), ("s2", 200, 0, "out_of_service")]
    send(spark, src, first)
    query = streams.stream_status(spark, src, dst, check, trigger=None)
    query.awaitTermination()
    assert streams.stream_progress(query)["input_rows"] == 3
    streams.stream_status(spark, src, dst, check, trigger=None).awaitTermination()
    assert spark.read.parquet(dst).count() == 3
    send(spark, src, [("s1", 300, 7, "active")])
    streams.stream_status(spark, src, dst, check, trigger=None, files_per_batch=1).awaitTermination()
    out = readers.read_table(spark, dst)
    assert rows(out) == rows(streams.status_events(spark.read.parquet(src)))
    assert dict(out.dtypes)["last_reported"] == "timestamp"
    s1 = out.where("station_id = 's1'")
    assert [r.num_bikes_available for r in explore.latest_rows(s1, "last_reported", 1).collect()] == [7]
    assert quality.duplicate_check(s1, ["last_reported"]).first().has_duplicates


def test_dedup_drops_repeats_and_reports_late_rows(spark, tmp_path):
    src, dst, check = (str(tmp_path / p) for p in ("src", "dst", "check"))

    def run():
        query = streams.stream_status(spark, src, dst, check, trigger=None, dedup_within="1 hour")
        query.awaitTermination()
        return query

    send(spark, src, [("s1", DAY, 5, "active"), ("s1", DAY, 5, "active"), ("s2", DAY, 5, "active")])
    run()
    send(spark, src, [("s1", DAY, 5, "active"), ("s1", DAY + 60, 6, "active"), ("s1", 2 * DAY, 7, "active")])
    run()
    send(spark, src, [("s2", DAY + 60, 1, "active"), ("s1", 2 * DAY + 60, 8, "active")])
    query = run()
    late = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert late == 1
    got = rows(spark.read.parquet(dst).select("station_id", F.unix_timestamp("last_reported"), "num_bikes_available"))
    assert got == [
        ("s1", 172800, 7), ("s1", 172860, 8), ("s1", 86400, 5), ("s1", 86460, 6), ("s2", 86400, 5)
    ]


def test_weather_stream(spark, tmp_path):
    src, dst, check = (str(tmp_path / p) for p in ("src", "dst", "check"))
    data = [(1000, 1.0, 1000, 50, 2.0, 0.1, None), (1000, 1.0, 1000, 50, 2.0, 0.1, None), (4600, 2.0, 1001, 51, 2.5, 0.2, 0.3)]
    send(spark, src, data, LIVE_WEATHER_RAW)
    streams.stream_weather(spark, src, dst, check, trigger=None, dedup_within="2 hours").awaitTermination()
    out = spark.read.parquet(dst)
    assert rows(out.select(F.unix_timestamp("dt"), "rain_1h")) == [(1000, None), (4600, 0.3)]


def test_interval_trigger_runs_until_stopped(spark, tmp_path):
    src, dst, check = (str(tmp_path / p) for p in ("src", "dst", "check"))
    send(spark, src, [("s1", 100, 5, "active")])
    query = streams.stream_status(spark, src, dst, check, trigger="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and query.name == "station_status"
        assert "message" in streams.stream_progress(query)["status"]
    finally:
        query.stop()
    assert spark.read.parquet(dst).count() == 1
