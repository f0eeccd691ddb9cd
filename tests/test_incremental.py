"""Silver from streams and ingestion of new files: late rows, restarts, cut-off batches."""

import dataclasses
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from dockflow.operators import flows
from dockflow.plans import pipeline
from dockflow.sources import ingest, readers, writers
from dockflow.spec import HOURLY_READINGS, TRIPS_RAW
from dockflow.streaming import silver
from tests import data, test_pipeline
from tests.data import rows

WEATHER = "dt timestamp, " + ", ".join(f"{c} double" for c in HOURLY_READINGS)


def hours_of_weather(spark, first, count):
    return spark.createDataFrame([(first + timedelta(minutes=30 * i), *[float(i + k) for k in range(len(HOURLY_READINGS))]) for i in range(count)], WEATHER)


class City:
    """Folders of a silver stream over trips and weather."""

    def __init__(self, spark, base, delay="30 days"):
        self.spark, self.delay = spark, delay
        self.trips, self.weather, self.log, self.table, self.check = (str(base / p) for p in ("trips", "weather", "log", "silver", "check"))

    def send(self, trips=None, weather=None):
        for df, path in ((trips, self.trips), (weather, self.weather)):
            if df is not None:
                writers.write_table(df, path, mode="append")

    def run(self):
        sources = [readers.stream_table(self.spark, p, s) for p, s in ((self.trips, data.TRIP_DDL), (self.weather, WEATHER))]
        query = silver.stream_silver(*sources, self.log, self.table, self.check, delay=self.delay)
        query.awaitTermination()
        return query

    def silver(self):
        return rows(self.spark.read.parquet(self.table).select(*COLUMNS))


COLUMNS = ["station", "start_date_column", "start_hour", "num_rides_in", "num_rides_out", "net_change", "avg_temp", "avg_rain_1h"]


def batch(spark, trips, weather):
    return rows(flows.silver_hourly(trips, weather).select(*COLUMNS))


def test_stream_equals_batch_with_late_and_incomplete_rows(spark, tmp_path):
    city = City(spark, tmp_path)
    trips, weather = data.trips(spark), hours_of_weather(spark, datetime(2022, 1, 31, 20), 140)
    city.send(trips.where("ride_id in ('r7', 'r9')"), weather.where("dt >= '2022-02-02'"))
    city.run()
    first = city.silver()
    city.send(trips.where("ride_id not in ('r7', 'r9') or ride_id is null"), weather.where("dt < '2022-02-02'"))
    city.run()
    assert city.silver() == batch(spark, trips, weather) != first
    query = city.run()
    assert city.silver() == batch(spark, trips, weather)
    assert silver.read_movements(query) == 0
    # repeated and tied rows count as often as they come
    city.send(trips.where("ride_id = 'r9'"), weather.where("dt >= '2022-02-02 11:00:00' and dt < '2022-02-02 12:30:00'"))
    city.run()
    twice = trips.unionByName(trips.where("ride_id = 'r9'")), weather.unionByName(weather.where("dt >= '2022-02-02 11:00:00' and dt < '2022-02-02 12:30:00'"))
    assert city.silver() == batch(spark, *twice)


@pytest.mark.parametrize("place", ["before the log", "after the log", "after the days"])
def test_a_batch_cut_off_anywhere_is_repeated_without_trace(spark, tmp_path, monkeypatch, place):
    city = City(spark, tmp_path)
    trips, weather = data.trips(spark), hours_of_weather(spark, datetime(2022, 1, 31, 20), 140)
    city.send(trips.where("started_at < '2022-02-02'"), weather)
    city.run()
    city.send(trips.where("started_at >= '2022-02-02' or started_at is null"), weather.limit(0))
    real = silver.replace_days

    def failing(base, table, station="string"):
        write = real(base, table, station)

        def run(totals, number):
            if place == "after the log":
                monkeypatch.setattr(silver, "silver_of", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
            if place != "before the log":
                write(totals, number)
            raise RuntimeError("lost")

        return run

    monkeypatch.setattr(silver, "replace_days", failing)
    with pytest.raises(Exception, match="lost"):
        city.run()
    monkeypatch.undo()
    city.run()
    assert city.silver() == batch(spark, trips, weather)
    assert silver.counted_movements(spark, city.log) == 2 * trips.count() - 2 + weather.count()


def test_rows_beyond_the_watermark_are_left_out_and_counted(spark, tmp_path):
    city = City(spark, tmp_path, delay="2 hours")
    trips, weather = data.trips(spark), hours_of_weather(spark, datetime(2022, 1, 31, 20), 140)
    late = trips.where("ride_id = 'r1'")
    city.send(trips.where("ride_id != 'r1' or ride_id is null"), weather)
    read = silver.read_movements(city.run())
    city.send(late.unionByName(late), weather.limit(0))
    read += silver.read_movements(city.run())
    assert city.silver() == batch(spark, trips.where("ride_id != 'r1' or ride_id is null"), weather)
    assert read - silver.counted_movements(spark, city.log) == 4


def test_streams_without_rows(spark, tmp_path):
    city = City(spark, tmp_path)
    city.send(data.trips(spark).limit(0), hours_of_weather(spark, datetime(2022, 1, 31), 0))
    city.run()
    city.send(data.trips(spark), None)
    city.run()
    assert silver.latest_totals(spark, city.log).where("kind = 'weather'").count() == 0


CONTRACT = {c: TRIPS_RAW[c] for c in ("ride_id", "started_at", "start_lat")}


def test_a_second_run_reads_the_new_files_only(spark, tmp_path):
    src, dst, check = (str(tmp_path / p) for p in ("src", "dst", "check"))
    (tmp_path / "src").mkdir()

    def run(**options):
        return ingest.ingest_new_files(spark, src, dst, check, CONTRACT, **options)

    assert run() == []
    (tmp_path / "src" / "a.csv").write_text("ride_id,started_at,start_lat\n1,2022-01-03 10:00:00,1.5\n1,2022-01-03 10:00:00,1.5\n")
    (tmp_path / "src" / "b.csv").write_text("started_at,ride_id,helmet\nnot a time,2,yes\n")
    (tmp_path / "src" / "notes.txt").write_text("ride_id\n9\n")
    assert [b["files"] for b in run()] == [2]
    assert run() == []
    (tmp_path / "src" / "c.csv").write_text("ride_id,lamp\n3,on\n")
    (tmp_path / "src" / "d.csv").write_text("ride_id,lamp\n")
    found = run(files_per_batch=1)
    assert [b["files"] for b in found] == [1, 1]
    whole = readers.read_csv_contract(spark, src, CONTRACT, mixed_headers=True)
    columns = ["ride_id", "started_at", "start_lat", "helmet", "lamp"]
    got = ingest.read_ingested(spark, dst)
    assert sorted(got.columns) == sorted(columns)
    assert rows(got, *columns) == rows(whole, *columns) and got.count() == 4
    assert rows(ingest.read_ingested(spark, dst, [b["batch"] for b in found]), "ride_id") == [("3",)]


def test_a_cut_off_ingestion_leaves_no_row_twice(spark, tmp_path, monkeypatch):
    src, dst, check = (str(tmp_path / p) for p in ("src", "dst", "check"))
    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "a.csv").write_text("ride_id\n1\n2\n")
    real = ingest.read_csv_contract

    def half(*args, **options):
        real(*args, **options).limit(1).write.mode("overwrite").parquet(f"{dst}/batch=0")
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "read_csv_contract", half)
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_new_files(spark, src, dst, check, CONTRACT)
    monkeypatch.undo()
    assert [b["files"] for b in ingest.ingest_new_files(spark, src, dst, check, CONTRACT)] == [1]
    assert rows(ingest.read_ingested(spark, dst), "ride_id") == [("1",), ("2",)]


def test_incremental_pipeline_rebuilds_the_days_that_new_files_touch(spark, tmp_path):
    test_pipeline.write_inputs(spark, tmp_path)
    trips, kept = tmp_path / "trips", tmp_path / "later"
    kept.mkdir()
    lines = (trips / "202201.csv").read_text().splitlines(keepends=True)
    (trips / "202201.csv").unlink()
    for name, part in (("early", lines[1:-300]), ("late", lines[-300:])):
        (kept / f"{name}.csv").write_text("".join([lines[0], *part]))
    config = pipeline.PipelineConfig(
        trips_csv=str(trips), weather_csv=str(tmp_path / "weather"), status=str(tmp_path / "status"), live_weather=str(tmp_path / "live"),
        base=str(tmp_path / "lake"), database="dock_steps", now=test_pipeline.NOW, incremental=True,
    )
    spark.sql("CREATE DATABASE IF NOT EXISTS dock_steps")
    (trips / "early.csv").write_text((kept / "early.csv").read_text())
    pipeline.run_silver(spark, config, pipeline.run_ingest(spark, config))
    before = {r["name"]: r["at"] for r in folder_times(tmp_path / "lake" / "silver_weather_trip")}
    (trips / "late.csv").write_text((kept / "late.csv").read_text())
    days = pipeline.run_ingest(spark, config)
    assert 1 < len(days) < 8
    pipeline.run_silver(spark, config, days)
    after = {r["name"]: r["at"] for r in folder_times(tmp_path / "lake" / "silver_weather_trip")}
    assert {n for n in after if after[n] != before.get(n)} == {f"start_date_column={d}" for d in days}
    whole = dataclasses.replace(config, base=str(tmp_path / "whole"), incremental=False)
    pipeline.run_bronze(spark, whole)
    pipeline.run_silver(spark, whole)
    names = ["station", "start_date_column", "start_hour", "num_rides_in", "num_rides_out", F.round("avg_temp", 9)]
    parts = [spark.read.parquet(c.path("silver_weather_trip")).select(*names) for c in (config, whole)]
    assert rows(parts[0]) == rows(parts[1])
    assert pipeline.run_ingest(spark, config) == []
    spark.sql("USE default")


def folder_times(folder):
    return [{"name": p.name, "at": max(f.stat().st_mtime_ns for f in p.glob("*.parquet"))} for p in folder.glob("start_date_column=*")]
