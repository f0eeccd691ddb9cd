"""Stock between nothing and the docks, stages compared by bootstrap, percentiles between sketch bounds."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockflow.operators import bounded, evaluation, series

START = datetime(2024, 1, 1)
SCHEMA = "station string, ds timestamp, yhat double, note string"


def loop(steps, stock, docks):
    """[(bikes, lost departures, lost arrivals)] step by step."""
    out = []
    for _, _, yhat, _ in sorted(steps, key=lambda r: (r[1] is not None, r[1], r[2] is not None, r[2])):
        if stock is None or yhat is None or docks is None:
            stock = None
            out.append((None, None, None))
            continue
        wish = stock + round(yhat)
        stock = min(max(wish, 0), docks)
        out.append((stock, max(-wish, 0), max(wish - docks, 0)))
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.mark.parametrize("block", ["day", "hour", "month"])
def test_bounded_inventory_against_a_loop(spark, block):
    pick = random.Random(block)
    rows = []
    for station in ("A", "B", "C", None):
        for h in range(pick.choice([1, 70, 140])):
            rows.append((station, START + timedelta(hours=h), pick.choice([pick.uniform(-9, 9), 0.5, 1.5, -2.5]), "x"))
    out = bounded.bounded_inventory(frame(spark, rows), 3, capacity=10, block=block)
    got = {}
    for r in out.orderBy("ds").collect():
        got.setdefault(r.station, []).append((r.num_bikes_available, r.lost_departures, r.lost_arrivals))
    want = {s: loop([r for r in rows if r[0] == s], 3, 10) for s in {r[0] for r in rows}}
    assert got == want
    assert any(b for rows_ in want.values() for _, b, _ in rows_) and any(c for rows_ in want.values() for _, _, c in rows_)
    full = out.where("is_full != (num_bikes_available >= 10)").count()
    assert full == 0 and out.columns[:4] == ["station", "ds", "yhat", "note"]


def test_unknown_steps_ties_and_no_rows(spark):
    gap = [("A", START, -5.0, "a"), ("A", START + timedelta(hours=1), None, "b"), ("A", START + timedelta(days=2), 4.0, "c")]
    got = bounded.bounded_inventory(frame(spark, gap), 3).orderBy("ds").collect()
    assert [(r.num_bikes_available, r.lost_departures) for r in got] == [(0, 2), (None, None), (None, None)]
    tied = [("A", START, -5.0, "a"), ("A", START, 4.0, "b"), ("A", START, 4.0, "b"), ("A", None, 1.0, "c")]
    got = bounded.bounded_inventory(frame(spark, tied), 3, capacity=7).collect()
    assert sorted((str(r.ds), r.yhat, r.num_bikes_available) for r in got) == [("2024-01-01 00:00:00", -5.0, 0), ("2024-01-01 00:00:00", 4.0, 4), ("2024-01-01 00:00:00", 4.0, 7), ("None", 1.0, 4)]
    assert [r.num_bikes_available for r in bounded.bounded_inventory(frame(spark, tied), F.lit(None).cast("int")).collect()] == [None] * 4
    assert bounded.bounded_inventory(frame(spark, tied).limit(0), 3).count() == 0
    wide = bounded.bounded_inventory(frame(spark, tied[:1]), 500, capacity=7).first()
    assert (wide.num_bikes_available, wide.lost_arrivals, wide.is_full) == (7, 488, True)


def test_clamps_compose_like_steps(spark):
    pick = random.Random(1)
    rows = [(pick.randrange(-5, 20), [(pick.randrange(-9, 9), pick.randrange(1, 12)) for _ in range(3)]) for _ in range(200)]
    df = spark.createDataFrame([(x, *[v for step in steps for v in step]) for x, steps in rows], "x long, a1 long, c1 long, a2 long, c2 long, a3 long, c3 long")
    clamp = [F.struct(F.col(f"a{i}").alias("add"), F.lit(0).cast("long").alias("low"), F.col(f"c{i}").alias("high"), F.lit(True).alias("known")) for i in (1, 2, 3)]
    one = bounded.then(bounded.then(clamp[0], clamp[1]), clamp[2])
    two = bounded.then(clamp[0], bounded.then(clamp[1], clamp[2]))
    apply = lambda c: bounded.apply_clamp(c, F.col("x"))
    step = lambda x, i: F.least(F.greatest(x + F.col(f"a{i}"), F.lit(0)), F.col(f"c{i}"))
    by_hand = step(step(step(F.col("x"), 1), 2), 3)
    inner = df.select(apply(one).alias("one"), apply(two).alias("two"), by_hand.alias("hand"))
    assert inner.where("one != hand or two != hand").count() == 0


def gold(spark, rows):
    return spark.createDataFrame(rows, "station string, ds timestamp, stage string, residual double")


def test_stage_difference_finds_the_better_stage_and_its_uncertainty(spark):
    rng = np.random.default_rng(1)
    rows = []
    for h in range(2000):
        at, shared = START + timedelta(hours=h), rng.normal(0, 2)
        for stage, spread in (("Staging", 0.9), ("Production", 1.0)):
            rows.append(("A", at, stage, float(shared + rng.normal(0, spread))))
            rows.append(("B", at, stage, float(shared + rng.normal(0, 1.0))))
    got = {r.station: r for r in evaluation.stage_difference(gold(spark, rows), ["station"]).collect()}
    errors = {s: {t: np.array([abs(r[3]) for r in rows if r[0] == s and r[2] == t]) for t in ("Staging", "Production")} for s in "AB"}
    for s, r in got.items():
        apart = errors[s]["Staging"] - errors[s]["Production"]
        assert r.difference == pytest.approx(apart.mean()) and r.pairs == 2000
        spread = apart.std() / math.sqrt(2000)
        assert r.low < r.difference < r.high and (r.high - r.low) == pytest.approx(2 * 1.645 * spread, rel=0.4)
    assert got["B"].low < 0 < got["B"].high


def test_weights_are_poisson_and_agree_between_runs(spark):
    df = spark.range(20_000).select(evaluation.bootstrap_weights([F.col("id")], 16).alias("w")).select(F.explode("w").alias("w"))
    moments = df.agg(F.avg("w").alias("m"), F.var_pop("w").alias("v")).first()
    assert moments.m == pytest.approx(1, abs=0.01) and moments.v == pytest.approx(1, abs=0.02)
    one = [spark.range(50).repartition(n).select("id", evaluation.bootstrap_weights([F.col("id")], 10).alias("w")).orderBy("id").collect() for n in (1, 7)]
    assert one[0] == one[1]


def test_stages_without_partners_or_rows(spark):
    rows = [("A", START, "Staging", 1.0), ("A", START, "Staging", 3.0), ("A", START, "Production", -1.0), ("B", START, "Staging", 1.0), ("C", START, "Production", None), ("C", START, "Staging", 1.0)]
    got = evaluation.stage_difference(gold(spark, rows), ["station"]).collect()
    assert [(r.station, r.pairs, r.difference, r.low, r.high, r.better) for r in got] == [("A", 1, 1.0, 1.0, 1.0, 0.0)]
    assert evaluation.stage_difference(gold(spark, []), ["station"]).count() == 0


@pytest.mark.parametrize("probabilities", [[0.5], [0.0, 0.001, 0.25, 0.999, 1.0]])
def test_percentiles_of_large_groups_order_only_what_sketches_leave_open(spark, probabilities, monkeypatch):
    rng = np.random.default_rng(6)
    values = {"wide": rng.normal(size=60_000), "ties": rng.integers(0, 5, 30_000).astype(float), "few": rng.normal(size=7)}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(8)
    settled = {}
    keep = series.settle

    def watched(frame, label):
        settled[label] = keep(frame, label)
        return settled[label]

    monkeypatch.setattr(series, "settle", watched)
    got = {r.g: r.percentiles for r in series.exact_percentiles(df, ["g"], "v", probabilities).collect()}
    assert set(got) == set(values)
    for g, vs in values.items():
        assert got[g] == pytest.approx(np.quantile(vs, probabilities).tolist())
    assert settled["percentile-counts"].where("g = 'wide' and _value is not null").count() < 60_000 * 0.03


def test_a_rank_that_the_sketch_misses_is_found_again(spark, monkeypatch):
    real, slacks = series._brackets, []

    def narrow(sketches, keys, probabilities, k, slack):
        slacks.append(slack)
        bounds = real(sketches, keys, probabilities, k, slack)
        if len(slacks) > 1:
            return bounds
        return bounds.withColumn("_wanted", F.transform("_wanted", lambda w: w.withField("low", F.lit(1e9)).withField("high", F.lit(2e9))))

    monkeypatch.setattr(series, "_brackets", narrow)
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r.g: r.percentiles for r in series.exact_percentiles(df, ["g"], "v", [0.5]).collect()}
    assert got == {0: [9999.0], 1: [10000.0]} and len(slacks) == 2


def test_sketches_of_days_merge_into_that_of_the_whole(spark):
    df = spark.range(50_000).select((F.col("id") % 9).alias("day"), F.rand(3).alias("v"))
    whole = series.exact_percentiles(df, [], "v", [0.25, 0.5]).first().percentiles
    days = df.groupBy("day").agg(*series.sketch_columns(F.col("v")))
    merged = days.agg(F.sum("_rows").alias("_rows"), F.sum("_plain").alias("_plain"), F.kll_merge_agg_double("_sketch", series.SKETCH_SIZE).alias("_sketch"))
    assert series.exact_percentiles(df, [], "v", [0.25, 0.5], sketches=merged).first().percentiles == whole
