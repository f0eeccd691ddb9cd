"""Small hand-made inputs with the edge rows the operators must get right."""

from datetime import datetime, timedelta

import numpy as np
import pandas as pd

TRIP_DDL = (
    "ride_id string, start_station_name string, end_station_name string, started_at timestamp, ended_at timestamp, "
    "rideable_type string, member_casual string, end_lat double, end_lng double"
)


def at(text):
    return datetime.fromisoformat(text) if text else None


TRIPS = [
    # ride, from, to, start, end, bike, rider, lat, lng
    ("r1", "A", "B", "2022-01-31 23:50:00", "2022-02-01 00:10:00", "classic_bike", "member", 1.0, 2.0),
    ("r2", "A", "A", "2022-02-01 08:00:00", "2022-02-01 08:30:00", "electric_bike", "casual", 5.0, 6.0),
    ("r3", "B", "A", "2022-02-01 08:10:00", "2022-02-01 08:20:00", "classic_bike", "member", 7.0, 8.0),
    ("r4", "A", None, "2022-02-01 09:00:00", None, "docked_bike", "member", None, None),
    (None, "A", "B", "2022-02-01 09:10:00", "2022-02-01 09:40:00", "classic_bike", "casual", 3.0, 4.0),
    ("r6", "B", "C", "2022-02-02 10:00:00", "2022-02-02 09:00:00", None, "member", 9.0, 9.0),
    ("r7", "C", "A", "2022-02-02 11:00:00", "2022-02-03 13:00:05", "classic_bike", "casual", 0.0, 1.0),
    ("r8", None, "C", None, "2022-02-02 11:30:00", "classic_bike", "casual", 9.0, 9.0),
    ("r9", "A", "C", "2022-02-02 12:00:00", "2022-02-02 12:59:59.5", "classic_bike", "casual", 9.0, 9.0),
]


def trips(spark):
    rows = [(*t[:3], at(t[3]), at(t[4]), *t[5:]) for t in TRIPS]
    return spark.createDataFrame(rows, TRIP_DDL)


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)


def panel(spark, days=60, stations=("A", "B"), seed=1):
    """An hourly series per station with known weekday and hour means and a temperature effect."""
    rng = np.random.default_rng(seed)
    start = datetime(2022, 1, 3)
    out = []
    for number, station in enumerate(stations):
        for h in range(days * 24):
            ds = start + timedelta(hours=h)
            temp = 10 + 8 * np.sin(h / 90) + rng.normal()
            level = 3 * np.sin(2 * np.pi * ds.hour / 24) + (2 if ds.weekday() >= 5 else -1) + number
            out.append((station, ds, float(temp), float(level + 0.5 * temp + rng.normal() * 0.1)))
    return spark.createDataFrame(pd.DataFrame(out, columns=["station", "ds", "avg_temp", "y"]))
