from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dockflow.functions.timeparts import epoch_to_ts
from dockflow.operators import quality
from dockflow.session import scratch_path
from dockflow.sources import readers, writers
from dockflow.spec import TRIPS_RAW, WEATHER_RAW
from tests.data import rows, trips


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


WEATHER_A = """dt,temp,feels_like,pressure,humidity,clouds,visibility,wind_speed,wind_deg,pop,snow.1h,main,rain.1h
1667712600,10.5,9.0,1010,50,20,10000,3.5,180,0.2,,Clouds,
1667716200,oops,9.5,1011,51,20,10000,3.6,181,0.3,0.1,Snow,0.4
"""
WEATHER_B = """temp,dt,main,rain.1h,extra
7.5,1667719800,Rain,1.25,z
8.5,1667716200,Rain,2.25,z
"""


def test_weather_binds_by_header_and_nulls_bad_cells(spark, tmp_path):
    path = put(tmp_path / "w", "a.csv", WEATHER_A)
    put(tmp_path / "w", "notes.txt", "dt,temp\n1,2\n")
    df = readers.read_weather_csv(spark, path)
    assert df.columns == list(WEATHER_RAW) and dict(df.dtypes)["dt"] == "bigint"
    plain = readers.clean_names(df)
    assert rows(plain, "dt", "temp", "pressure", "snow_1h", "rain_1h") == [
        (1667712600, 10.5, 1010, None, None),
        (1667716200, None, 1011, 0.1, 0.4),
    ]


def test_differing_headers_are_refused_or_grouped(spark, tmp_path):
    path = put(tmp_path / "w", "a.csv", WEATHER_A)
    put(tmp_path / "w", "b.csv", WEATHER_B)
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_weather_csv(spark, path).collect()
    df = readers.clean_names(readers.read_weather_csv(spark, path, mixed_headers=True))
    assert rows(df, "dt", "temp", "main", "rain_1h", "humidity") == [
        (1667712600, 10.5, "Clouds", None, 50),
        (1667716200, 8.5, "Rain", 2.25, None),
        (1667716200, None, "Snow", 0.4, 51),
        (1667719800, 7.5, "Rain", 1.25, None),
    ]
    one = quality.dedup(epoch_to_ts(df, "dt"), ["dt"], [F.asc_nulls_last("temp")])
    assert one.count() == 3 and one.where("temp = 8.5").count() == 1
    extras = readers.read_weather_csv(spark, path, mixed_headers=True, extras=True)
    assert rows(extras.where("extra is not null"), "extra") == [("z",), ("z",)]


def test_no_files(spark, tmp_path):
    path = put(tmp_path / "none", "x.txt", "a")
    assert readers.read_weather_csv(spark, path, mixed_headers=True).count() == 0


TRIPS_CSV = """ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual
a1,classic_bike,2022-02-01 08:00:00,2022-02-01 08:30:00.250,A,1,"B, north",2,40.1,-73.9,40.2,-73.8,member
a2,electric_bike,not a time,2022-02-01 09:30:00,A,1,,,40.1,-73.9,,,casual
"""


def test_trips(spark, tmp_path):
    df = readers.read_trips_csv(spark, put(tmp_path / "t", "202202.csv", TRIPS_CSV))
    assert df.columns == list(TRIPS_RAW)
    assert rows(df, "ride_id", "member_casual", "started_at", "ended_at", "end_station_name", "end_lat") == [
        ("a1", "member", datetime(2022, 2, 1, 8), datetime(2022, 2, 1, 8, 30, 0, 250000), "B, north", 40.2),
        ("a2", "casual", None, datetime(2022, 2, 1, 9, 30), None, None),
    ]
    inferred = readers.read_csv_inferred(spark, str(tmp_path / "t"))
    assert dict(inferred.dtypes)["start_lat"] == "double" and inferred.count() == 2


def test_all_files_are_one_scan(spark, tmp_path):
    for i in range(5):
        path = put(tmp_path / "t", f"{i}.csv", TRIPS_CSV)
    plan = readers.read_trips_csv(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_union_and_empty(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, 0.5)], "k int, w double")
    assert rows(readers.union_sources([a, b])) == [(1, "x", None), (2, None, 0.5)]
    assert readers.union_sources([readers.empty(spark, "k int, v string"), a]).count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_table_round_trip_and_overwrite(spark, tmp_path, fmt):
    path = str(tmp_path / "t")
    df = trips(spark).select("ride_id", "start_station_name", "end_lat")
    for _ in range(2):
        writers.write_table(df, path, fmt)
    assert rows(readers.read_table(spark, path, fmt), *df.columns) == rows(df)


def test_catalog(spark, tmp_path):
    df = trips(spark).select("ride_id", "end_station_name")
    writers.ensure_database(spark, "dock_test")
    for _ in range(2):
        writers.save_managed(df, "dock_test.managed")
        writers.publish(df, str(tmp_path / "p"), "dock_test.published")
        writers.publish(df, str(tmp_path / "q"), "dock_test.parted", by=["end_station_name"])
    for name in ("managed", "published", "parted"):
        assert rows(spark.table(f"dock_test.{name}"), *df.columns) == rows(df)
    plan = spark.table("dock_test.parted").where("end_station_name = 'A'")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(end_station_name" in plan.toString()
    writers.drop_table(spark, "dock_test.managed")
    writers.drop_table(spark, "dock_test.managed")
    assert "managed" not in {t.name for t in spark.catalog.listTables("dock_test")}
    spark.sql("USE default")


def test_layout(spark, tmp_path):
    path = str(tmp_path / "c")
    # A third of all rows share one key; the spread column cuts them over several files.
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 100).alias("k"), "id")
    writers.write_table(writers.cluster_by(df, "k", 6, spread=["id"]), path)
    detail = writers.table_detail(spark.read.parquet(path)).first()
    assert detail.num_rows == 30000 and detail.num_files == 6 and detail.size_in_bytes > 0
    sizes = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count()
    assert sizes.agg(F.max("count")).first()[0] < 30000 / 6 * 1.5
    even = str(tmp_path / "b")
    writers.write_table(writers.balance(df, 4), even)
    assert writers.table_detail(spark.read.parquet(even)).first().num_files == 4
    assert writers.partition_count(df.repartition(5)) == 5
    assert writers.balance(df).count() == 30000


def test_scratch_needs_a_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_settled_result_starts_from_files(spark):
    df = writers.settle(spark.range(5).groupBy().count(), "n")
    assert df.first()[0] == 5
    assert "Aggregate" not in df._jdf.queryExecution().executedPlan().toString()


def test_counts_of_the_writing_pass_are_those_of_a_read_of_its_own(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("dt,temp\n1,mild\nx,2.5\n,\n")
    (tmp_path / "in" / "b.csv").write_text("temp,humidity,dt\n1.5,wet,7\n1.5,wet,7\n")
    contract = {"dt": "bigint", "temp": "double", "humidity": "int", "pop": "double"}
    typed, seen = readers.read_csv_counted(spark, str(tmp_path / "in"), contract, mixed_headers=True)
    kept = writers.settle(typed, "typed")
    got = {r.column: (r.rows, r.unreadable) for r in readers.counted_cells(spark, seen, contract).collect()}
    assert got == {"dt": (5, 1), "temp": (5, 1), "humidity": (5, 2), "pop": (5, 0)}
    assert rows(kept) == rows(readers.read_csv_contract(spark, str(tmp_path / "in"), contract, mixed_headers=True))
    (tmp_path / "none").mkdir()
    typed, seen = readers.read_csv_counted(spark, str(tmp_path / "none"), contract, mixed_headers=True)
    assert typed.count() == 0 and {r.rows for r in readers.counted_cells(spark, seen, contract).collect()} == {0}
