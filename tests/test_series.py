"""Running totals, fills and percentiles against brute force, hot series included."""

import math
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dockflow.operators import inventory, series
from tests.data import rows

START = datetime(2022, 1, 30)
steps = st.lists(
    st.tuples(st.sampled_from("HHHHab"), st.integers(0, 90), st.one_of(st.none(), st.integers(-9, 9))), max_size=60
)
some = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, data):
    out = [(i, s, START + timedelta(hours=h), v) for i, (s, h, v) in enumerate(data)]
    return spark.createDataFrame(out, "id int, station string, ts timestamp, v int")


@some
@given(data=steps)
def test_running_total(spark, data):
    df = frame(spark, data)
    got = {r.id: r.total for r in series.running_total(df, ["station"], "ts", "v", "total", ["id"], "day").collect()}
    sums = {}
    for i, (s, h, v) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        sums[s] = sums.get(s, 0) + (v or 0)
        assert got[i] == sums[s]
    assert len(got) == len(data)


@some
@given(data=steps)
def test_forward_fill(spark, data):
    df = frame(spark, data)
    filled = series.forward_fill(df, ["station"], "ts", ["v"], ["id"], "day")
    got = {r.id: r.v for r in filled.collect()}
    last = {}
    for i, (s, h, v) in sorted(enumerate(data), key=lambda x: (x[1][1], x[0])):
        last[s] = v if v is not None else last.get(s)
        assert got[i] == last[s]
    assert filled.columns == df.columns
    again = series.forward_fill(filled, ["station"], "ts", ["v"], ["id"], "day")
    assert rows(again) == rows(filled)


def test_rows_stay_where_the_window_put_them(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = series.running_total(frame(spark, [("a", 1, 2)]), ["station"], "ts", "v", "total", ["id"])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    left = plan[plan.index("SortMergeJoin") :].split("Window", 1)[0]
    assert "Exchange" not in left


values = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(
            st.none(), st.just(0.0), st.floats(-1e9, 1e9), st.floats(-1e-7, 1e-7), st.sampled_from([1.5, 2.5])
        ),
    ),
    max_size=50,
)


@some
@given(data=values)
def test_exact_percentiles(spark, data):
    probabilities = [0.0, 0.1, 0.5, 0.75, 1.0]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r.g: r.percentiles for r in series.exact_percentiles(df, ["g"], "v", probabilities).collect()}
    groups = {}
    for g, v in data:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g] == pytest.approx(list(np.percentile(vs, [100 * p for p in probabilities])), rel=1e-9, abs=1e-12)
    everything = series.exact_percentiles(df, [], "v", [0.5]).collect()
    flat = [v for vs in groups.values() for v in vs]
    assert len(everything) == (1 if flat else 0)
    if flat:
        assert everything[0].percentiles[0] == pytest.approx(np.median(flat), rel=1e-9, abs=1e-12)


def test_percentiles_of_one_hot_value(spark):
    data = pd.DataFrame({"g": ["x"] * 3000, "v": [0.0] * 2000 + list(np.linspace(1, 2, 1000))})
    got = series.exact_percentiles(spark.createDataFrame(data), ["g"], "v", [0.5, 0.9]).first().percentiles
    assert got == pytest.approx(list(np.percentile(data.v, [50, 90])))


def test_future_frame(spark):
    df = frame(spark, [("a", 0, 1), ("a", 5, 1), ("b", 2, 1)])
    future = series.future_frame(df, ["station"], "ts", 3)
    ahead = rows(future.where("is_future"), "station", "ts")
    assert ahead == [("a", START + timedelta(hours=h)) for h in (6, 7, 8)] + [
        ("b", START + timedelta(hours=h)) for h in (3, 4, 5)
    ]
    assert future.where("not is_future").count() == 3


def test_running_inventory_rounds_half_to_even(spark):
    changes = [0.5, 1.5, 2.5, -0.5, -7.4]
    data = [("a", START + timedelta(hours=i), c) for i, c in enumerate(changes)]
    df = spark.createDataFrame(data, "station string, ds timestamp, yhat double")
    got = inventory.running_inventory(df, 10).orderBy("ds").collect()
    expected = 10 + np.cumsum(np.round(changes))
    assert [r.num_bikes_available for r in got] == list(expected)
    assert got[-1].num_bikes_available == 10 + int(sum(np.round(changes)))
    stock = spark.createDataFrame([("a", 100)], "station string, num_bikes_available int")
    assert inventory.running_inventory(df, stock).agg({"num_bikes_available": "max"}).first()[0] == 104
    assert math.isclose(got[0].yhat, 0.5)
