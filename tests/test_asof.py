"""The newest earlier row of another table."""

import bisect
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from dockflow.operators import asof, inventory, series

START = datetime(2024, 1, 1)


def minute(n):
    return None if n is None else START + timedelta(minutes=n)


def brute(left, right, tolerance=None):
    """[(id, matched value)] by bisection per series."""
    lines = {}
    for s, t, v in right:
        if s is not None and t is not None:
            lines.setdefault(s, []).append((t, v is not None, v))
    out = []
    for number, (s, t) in enumerate(left):
        rows = sorted(lines.get(s, [])) if s is not None and t is not None else []
        at = bisect.bisect_right(rows, (t, True, float("inf"))) if rows else 0
        near = at > 0 and (tolerance is None or t - rows[at - 1][0] <= tolerance)
        out.append((number, rows[at - 1][2] if near else None))
    return out


def frames(spark, left, right):
    rows = [(i, s, minute(t), "clash") for i, (s, t) in enumerate(left)]
    ours = spark.createDataFrame(rows, "id int, station string, ts timestamp, _side string")
    theirs = spark.createDataFrame([(s, minute(t), v) for s, t, v in right], "station string, dt timestamp, value int")
    return ours.repartition(5), theirs.repartition(3)


def test_random_rows_against_bisection(spark):
    pick = random.Random(4)
    station = lambda: pick.choice(["A", "A", "A", "B", "C", None])
    left = [(station(), pick.choice([pick.randrange(500), None, 250])) for _ in range(800)]
    right = [(station(), pick.choice([pick.randrange(500), None, 250]), pick.choice([pick.randrange(9), None])) for _ in range(150)]
    ours, theirs = frames(spark, left, right)
    for tolerance in (None, 3):
        span = timedelta(minutes=tolerance) if tolerance is not None else None
        got = asof.asof_join(ours, theirs, "ts", "dt", ["station"], tolerance=span)
        assert got.columns == ["id", "station", "ts", "_side", "dt", "value"]
        assert sorted((r.id, r.value) for r in got.collect()) == brute(left, right, tolerance)


def test_empty_sides_and_repeated_rows(spark):
    ours, theirs = frames(spark, [("A", 5), ("A", 5), ("A", 1)], [("A", 5, 1), ("A", 5, 2), ("A", 5, 2)])
    got = asof.asof_join(ours, theirs, "ts", "dt", ["station"], ["value"], prefix="w_")
    assert sorted((r.id, r.w_value) for r in got.collect()) == [(0, 2), (1, 2), (2, None)]
    assert [r.value for r in asof.asof_join(ours, theirs.limit(0), "ts", "dt", ["station"]).collect()] == [None] * 3
    assert asof.asof_join(ours.limit(0), theirs, "ts", "dt", ["station"]).count() == 0


def test_a_series_with_half_of_all_rows_is_spread(spark):
    hot = [("A", i) for i in range(20_000)] + [(f"s{i % 500}", i) for i in range(20_000)]
    right = [("A", i, i) for i in range(0, 20_000, 50)]
    ours, theirs = frames(spark, hot, right)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    line = asof.tagged(ours, theirs, "ts", "dt", ["station"], ["value"])
    sizes = series._blocked(line, ["station"], "_at", ["_side", "_seen"], None).groupBy("_block").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("station") == "A").alias("hot")
    ).collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.hot > 0 for r in sizes) >= 4 and max(r.n for r in sizes) < 20_000
    got = asof.asof_join(ours, theirs, "ts", "dt", ["station"], ["value"]).where("station = 'A'")
    assert got.where("value != id - id % 50 or value is null").count() == 0


def test_reports_of_hours_without_weather_take_the_newest_earlier_one(spark):
    status = spark.createDataFrame([("A", minute(m), 1) for m in (5, 65, 200, 500)], "station_id string, last_reported timestamp, num_bikes_available int")
    weather = spark.createDataFrame([(minute(10), 4.0, 1), (minute(70), 6.0, 2)], "dt timestamp, temp double, pressure int").withColumns(
        {c: F.lit(0.0) for c in ("humidity", "wind_speed", "pop", "rain_1h")}
    )
    now = minute(510)
    plain = inventory.inference_frame(status.where("last_reported > '2024-01-01 02:00:00'"), weather, now, 9)
    assert [r.avg_temp for r in plain.collect()] == [None, None]
    near = inventory.inference_frame(status, weather, now, 9, within=timedelta(hours=3))
    # the last report is beyond the tolerance and falls back on the report before it, as gaps always do
    assert [r.avg_temp for r in near.orderBy("ds").collect()] == [4.0, 6.0, 6.0, 6.0]
    alone = inventory.inference_frame(status.where("last_reported > '2024-01-01 05:00:00'"), weather, now, 9, within=timedelta(hours=3))
    assert [r.avg_temp for r in alone.collect()] == [None]
