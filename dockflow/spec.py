"""Column bindings and table contracts.

Every operator takes a binding instead of hard-wired column names, so the same plan runs on bike trips, on any
other dock-based sharing system, or on a test table that merely has the right shape.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple


class Side(NamedTuple):
    """One end of a trip: where it is, when it happens, and the station at the other end."""

    station: str
    at: str
    partner: str


@dataclass(frozen=True)
class TripSpec:
    """Names of the trip columns an operator needs."""

    ride: str = "ride_id"
    start_station: str = "start_station_name"
    end_station: str = "end_station_name"
    started_at: str = "started_at"
    ended_at: str = "ended_at"
    bike_type: str = "rideable_type"
    rider_type: str = "member_casual"
    end_lat: str = "end_lat"
    end_lng: str = "end_lng"

    def side(self, name: str) -> Side:
        """``"start"`` or ``"end"`` of the trip."""
        if name == "start":
            return Side(self.start_station, self.started_at, self.end_station)
        if name == "end":
            return Side(self.end_station, self.ended_at, self.start_station)
        raise ValueError(f"a trip has a start and an end, not {name!r}")


# Raw table contracts, in the order of the published files.
WEATHER_RAW = {
    "dt": "bigint",
    "temp": "double",
    "feels_like": "double",
    "pressure": "int",
    "humidity": "int",
    "clouds": "int",
    "visibility": "int",
    "wind_speed": "double",
    "wind_deg": "int",
    "pop": "double",
    "snow.1h": "double",
    "main": "string",
    "rain.1h": "double",
}
TRIPS_RAW = {
    "ride_id": "string",
    "rideable_type": "string",
    "start_station_name": "string",
    "start_station_id": "string",
    "end_station_name": "string",
    "end_station_id": "string",
    "member_casual": "string",
    "started_at": "timestamp",
    "ended_at": "timestamp",
    "end_lng": "double",
    "end_lat": "double",
    "start_lng": "double",
    "start_lat": "double",
}
STATUS_RAW = "station_id string, last_reported bigint, num_bikes_available int, station_status string"
LIVE_WEATHER_RAW = (
    "dt bigint, temp double, pressure int, humidity int, wind_speed double, pop double, `rain.1h` double"
)

# Weather readings averaged into the hourly table, and the ones the forecaster uses.
HOURLY_READINGS = ["temp", "feels_like", "pressure", "humidity", "wind_speed", "pop", "snow_1h", "rain_1h"]
REGRESSORS = [
    "avg_temp",
    "avg_pressure",
    "avg_humidity",
    "avg_wind_speed",
    "avg_pop",
    "avg_snow_1h",
    "avg_rain_1h",
]
DEFAULT_CAPACITY = 105
