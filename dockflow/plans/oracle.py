"""The registered queries as plain SQL over the same tables, written independently of the operators."""

from __future__ import annotations

WEATHER = """
weather AS (
  SELECT ts AS dt, value AS temp, value - 2 AS feels_like,
         CAST(1000 + event_id % 40 AS INTEGER) AS pressure, CAST(user_id % 100 AS INTEGER) AS humidity,
         value / 10 AS wind_speed, CAST(event_id % 10 AS DOUBLE) / 10 AS pop,
         CASE WHEN event_id % 4 <> 0 THEN greatest(40 - value, 0.0) END AS snow_1h,
         CASE WHEN value > 80 THEN value - 80 END AS rain_1h
  FROM events WHERE event_type = 'error')"""

STATUS = """
status AS (
  SELECT event_id, user_id % 10 AS station, ts AS last_reported,
         CAST(trunc(value) AS INTEGER) AS num_bikes_available
  FROM events WHERE event_type = 'purchase')"""

HOURLY_STATUS = STATUS + """,
ranked_status AS (
  SELECT station, date_trunc('hour', last_reported) AS ds, num_bikes_available,
         row_number() OVER (PARTITION BY station, date_trunc('hour', last_reported)
                            ORDER BY last_reported DESC, num_bikes_available DESC) AS rk
  FROM status),
hourly_status AS (SELECT station, ds, num_bikes_available FROM ranked_status WHERE rk = 1)"""

FLOWS = """
flows AS (
  SELECT user_id % 10 AS station, date_trunc('hour', ts) AS h,
         count(*) FILTER (event_type = 'click') AS num_rides_in,
         count(*) FILTER (event_type = 'view') AS num_rides_out
  FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2)"""

FLOW_COLUMNS = """station, CAST(h AS DATE) AS start_date_column, strftime(h, '%H:00') AS start_hour,
  num_rides_in, num_rides_out, num_rides_in - num_rides_out AS net_change"""

READINGS = ["temp", "feels_like", "pressure", "humidity", "wind_speed", "pop", "snow_1h", "rain_1h"]

HOURLY_WEATHER = (
    WEATHER
    + ",\nhourly AS (SELECT date_trunc('hour', dt) AS wh, "
    + ", ".join(f"avg({r}) AS avg_{r}" for r in READINGS)
    + " FROM weather GROUP BY 1)"
)
AVERAGES = ", ".join(f"round(avg_{r}, 6) AS avg_{r}" for r in READINGS)
REGRESSORS = ["temp", "pressure", "humidity", "wind_speed", "pop", "snow_1h", "rain_1h"]
REGRESSOR_AVERAGES = ", ".join(f"round(avg_{r}, 6) AS avg_{r}" for r in REGRESSORS)

FRAME = FLOWS + """,
frame AS (SELECT station, h AS ds, num_rides_in - num_rides_out AS y FROM flows)"""

WIDTH = "1.2815515655446004"
PROFILE = FRAME + f""",
slots AS (
  SELECT station, dayofweek(ds) AS dow, hour(ds) AS hh, avg(y) AS m,
         sqrt(greatest(avg(y * y) - avg(y) * avg(y), 0)) * {WIDTH} AS w
  FROM frame GROUP BY ALL),
profile AS (SELECT station, dow, hh, m AS yhat, m - w AS yhat_lower, m + w AS yhat_upper FROM slots)"""

FITTED = PROFILE + """,
fitted AS (
  SELECT f.station, f.ds, f.y, p.yhat FROM frame f
  JOIN profile p ON p.station = f.station AND p.dow = dayofweek(f.ds) AND p.hh = hour(f.ds))"""

FUTURE = """
future AS (
  SELECT station, ds, false AS is_future FROM frame
  UNION ALL
  SELECT station, unnest(generate_series(last + INTERVAL 1 HOUR, last + INTERVAL 24 HOUR, INTERVAL 1 HOUR)), true
  FROM (SELECT station, max(ds) AS last FROM frame GROUP BY 1))"""

CUTOFFS = FRAME + """,
spans AS (SELECT station, min(ds) AS first, max(ds) AS last FROM frame GROUP BY 1),
numbered AS (
  SELECT station, first, last,
         unnest(generate_series(0, greatest(-1, CAST(floor((epoch(last) - epoch(first) - 18 * 86400) / 172800) AS BIGINT)))) AS k
  FROM spans),
cutoffs AS (
  SELECT station, CAST(k AS INTEGER) AS fold, last - INTERVAL 4 DAY - k * INTERVAL 2 DAY AS cutoff FROM numbered)"""

CV = CUTOFFS + f""",
trained AS (
  SELECT c.station, c.fold, dayofweek(f.ds) AS dow, hour(f.ds) AS hh, avg(y) AS m,
         sqrt(greatest(avg(y * y) - avg(y) * avg(y), 0)) * {WIDTH} AS w
  FROM cutoffs c JOIN frame f ON f.station = c.station AND f.ds <= c.cutoff GROUP BY ALL),
overall AS (
  SELECT c.station, c.fold, avg(y) AS m, sqrt(greatest(avg(y * y) - avg(y) * avg(y), 0)) * {WIDTH} AS w
  FROM cutoffs c JOIN frame f ON f.station = c.station AND f.ds <= c.cutoff GROUP BY ALL),
cv AS (
  SELECT f.station, c.fold, f.ds, f.y, coalesce(t.m, o.m) AS yhat,
         coalesce(t.m, o.m) - coalesce(t.w, o.w) AS yhat_lower, coalesce(t.m, o.m) + coalesce(t.w, o.w) AS yhat_upper,
         coalesce(t.m, o.m) - f.y AS residual
  FROM cutoffs c
  JOIN frame f ON f.station = c.station AND f.ds > c.cutoff AND f.ds <= c.cutoff + INTERVAL 4 DAY
  LEFT JOIN trained t ON t.station = c.station AND t.fold = c.fold AND t.dow = dayofweek(f.ds) AND t.hh = hour(f.ds)
  LEFT JOIN overall o ON o.station = c.station AND o.fold = c.fold)"""

METRICS = """round(avg((yhat - y) * (yhat - y)), 6) AS mse, round(sqrt(avg((yhat - y) * (yhat - y))), 6) AS rmse,
  round(avg(abs(yhat - y)), 6) AS mae, round(median(abs((yhat - y) / nullif(y, 0))), 6) AS mdape,
  round(avg(CASE WHEN y BETWEEN yhat_lower AND yhat_upper THEN 1.0 ELSE 0.0 END), 6) AS coverage"""

OD = """
od AS (
  SELECT l_orderkey AS ride_id, l_returnflag AS rideable_type, c_mktsegment AS member_casual,
         cn.n_name AS start_station_name, sn.n_name AS end_station_name,
         o_orderdate AS started_at, l_shipdate AS ended_at, l_extendedprice AS end_lat, l_discount AS end_lng
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey)"""

DAILY = """
daily AS (SELECT CAST(o_orderdate AS DATE) AS date, count(o_orderkey) AS trip_count FROM orders GROUP BY 1)"""

PAIRED = WEATHER + """,
trips_h AS (SELECT date_trunc('hour', ts) AS d, count(event_id) AS trip_count FROM events GROUP BY 1),
weather_h AS (
  SELECT date_trunc('hour', dt) AS d, avg(temp) AS t, avg(rain_1h) AS r, avg(wind_speed) AS w FROM weather GROUP BY 1),
paired AS (SELECT trip_count, t, r, w FROM trips_h JOIN weather_h USING (d))"""


def _holiday(d: str) -> str:
    """Federal holidays of a date expression."""
    month, day, dow = f"month({d})", f"day({d})", f"dayofweek({d})"
    return f"""CASE
    WHEN {month} = 1 AND {day} = 1 THEN 'New Year''s Day'
    WHEN {month} = 1 AND {dow} = 1 AND {day} BETWEEN 15 AND 21 THEN 'Martin Luther King Jr. Day'
    WHEN {month} = 2 AND {dow} = 1 AND {day} BETWEEN 15 AND 21 THEN 'Presidents'' Day'
    WHEN {month} = 5 AND {dow} = 1 AND {day} >= 25 THEN 'Memorial Day'
    WHEN {month} = 7 AND {day} = 4 THEN 'Independence Day'
    WHEN {month} = 9 AND {dow} = 1 AND {day} <= 7 THEN 'Labor Day'
    WHEN {month} = 10 AND {dow} = 1 AND {day} BETWEEN 8 AND 14 THEN 'Columbus Day'
    WHEN {month} = 11 AND {day} = 11 THEN 'Veterans Day'
    WHEN {month} = 11 AND {dow} = 4 AND {day} BETWEEN 22 AND 28 THEN 'Thanksgiving Day'
    WHEN {month} = 12 AND {day} = 25 THEN 'Christmas Day' END"""


def _fixed_day(d: str) -> str:
    return f"""CASE strftime({d}, '%m-%d')
    WHEN '01-01' THEN 'New Year''s Day' WHEN '07-04' THEN 'Independence Day' WHEN '11-11' THEN 'Veterans Day'
    WHEN '12-25' THEN 'Christmas Day' WHEN '02-12' THEN 'Lincoln''s Birthday'
    WHEN '02-15' THEN 'Susan B. Anthony Day'
    WHEN '06-19' THEN CASE WHEN year({d}) >= 2021 THEN 'Juneteenth' END END"""


def _extended(d: str) -> str:
    return f"""coalesce({_holiday(d)}, {_fixed_day(d)},
    CASE WHEN month({d}) = 11 AND dayofweek({d}) = 2 AND day({d}) BETWEEN 2 AND 8 THEN 'Election Day' END,
    CASE WHEN dayofweek({d}) = 5 THEN {_fixed_day(f"({d} + 1)")} || ' (Observed)'
         WHEN dayofweek({d}) = 1 THEN {_fixed_day(f"({d} - 1)")} || ' (Observed)' END)"""


def _calendar(source: str, name: str) -> str:
    return f"""
WITH span AS ({source}),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM span),
named AS (SELECT date, dayofweek(date) IN (0, 6) AS is_weekend, {name} AS holiday_name FROM days)
SELECT date, is_weekend, holiday_name IS NOT NULL AS is_holiday,
       is_weekend OR holiday_name IS NOT NULL AS is_off_day, holiday_name FROM named"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _trips_per(side: str, event: str, out: str) -> str:
    return f"""
SELECT station, CAST(h AS DATE) AS {side}_date_column, strftime(h, '%H:00') AS {side}_hour, {out}
FROM (SELECT user_id % 10 AS station, date_trunc('hour', ts) AS h, count(event_id) AS {out}
      FROM events WHERE event_type = '{event}' GROUP BY 1, 2)"""


def _top(side: str, other: str, n: int) -> str:
    return f"""
{_with(OD)}, counted AS (
  SELECT {side}_station_name AS station, {other}_station_name AS partner, count(ride_id) AS trip_count
  FROM od WHERE start_station_name <> end_station_name GROUP BY 1, 2)
SELECT station, partner, trip_count FROM counted
QUALIFY row_number() OVER (PARTITION BY station ORDER BY trip_count DESC, partner) <= {n}"""


STOCK_MESSAGE = """CASE
  WHEN bikes / 105.0 >= 0.5 THEN 'Enough Bikes Available'
  WHEN bikes / 105.0 >= 0.25 THEN 'Some Bikes Available, Restocking should be considered'
  WHEN bikes / 105.0 >= 0.1 THEN 'Few Bikes Available, Restocking should be immminent'
  WHEN bikes > 0 THEN 'Very Few Bikes Available, Restock As Soon As Possible'
  ELSE 'No Bikes Available, Restock Now' END"""

NOW = "TIMESTAMP '2024-01-20 12:00:00'"

GOLD = FITTED + "," + HOURLY_STATUS + f""",
staged AS (
  SELECT station, ds, stage, CASE WHEN stage = 'Staging' THEN yhat ELSE yhat / 2 END AS yhat
  FROM fitted CROSS JOIN (VALUES ('Staging'), ('Production')) v(stage)),
start_stock AS (
  SELECT station, num_bikes_available AS start FROM status WHERE last_reported <= {NOW}
  QUALIFY row_number() OVER (PARTITION BY station ORDER BY last_reported DESC, num_bikes_available DESC) = 1),
moved AS (
  SELECT station, stage, ds, CAST(sum(round_even(yhat, 0)) OVER (
           PARTITION BY station, stage ORDER BY ds ROWS UNBOUNDED PRECEDING) AS BIGINT) AS moved FROM staged),
gold AS (
  SELECT station, stage, ds, start + moved AS bikes, CAST(num_bikes_available AS INTEGER) AS seen
  FROM moved LEFT JOIN start_stock USING (station) JOIN hourly_status USING (station, ds))"""



def _ridge_line(groups: str, rows: str) -> str:
    """Ridge line of ``y`` on scaled time per group, from ``rows`` (groups, t, y): the slope alone is penalised.

    The noise in the penalty is that of a first, loosely penalised line.
    """
    return f"""
sums AS (
  SELECT {groups}, count(*) AS n, sum(t) AS t1, sum(t * t) AS t2, sum(CAST(y AS DOUBLE)) AS y1, sum(t * y) AS ty,
         sum(CAST(y * y AS DOUBLE)) AS y2, max(abs(y)) AS top, (count(*) + sum(t * t)) / 2 AS size
  FROM {rows} GROUP BY {groups}),
loose AS (
  SELECT *, n + size * 1.001e-6 AS a, t2 + size * 1.001e-6 AS d FROM sums),
first_line AS (
  SELECT *, (y1 * d - t1 * ty) / (a * d - t1 * t1) AS b0, (a * ty - t1 * y1) / (a * d - t1 * t1) AS b1 FROM loose),
noisy AS (
  SELECT *, greatest(y2 - 2 * (b0 * y1 + b1 * ty) + b0 * b0 * n + 2 * b0 * b1 * t1 + b1 * b1 * t2, 0) / n AS noise
  FROM first_line),
tight AS (
  SELECT *, n + size * 1e-9 AS a2, t2 + size * 1e-9 + greatest(noise, 1e-12) / (25 * top * top) AS d2 FROM noisy),
line AS (
  SELECT {groups}, n, (y1 * d2 - t1 * ty) / (a2 * d2 - t1 * t1) AS c0, (a2 * ty - t1 * y1) / (a2 * d2 - t1 * t1) AS c1
  FROM tight)"""


def _bent_line(groups: str, rows: str, sparse: bool, scale: str = "0.05") -> str:
    """A line with one bend per group, from ``rows`` (groups, t, h, y) with ``h`` the hinge: (c0, c1, c2, n, sigma).

    Level and slope are eliminated, which leaves the bend alone: a quotient under a ridge penalty, and the same after
    soft thresholding under an absolute one.
    """

    def solved(name: str, source: str, a: str, d: str, e: str, bend: str) -> str:
        return f"""
{name}0 AS (SELECT *, {a} AS a, {d} AS d, {e} AS e FROM {source}),
{name}1 AS (
  SELECT *, (d * h1 - t1 * th) / (a * d - t1 * t1) AS p0, (a * th - t1 * h1) / (a * d - t1 * t1) AS p1,
         (d * y1 - t1 * ty) / (a * d - t1 * t1) AS q0, (a * ty - t1 * y1) / (a * d - t1 * t1) AS q1 FROM {name}0),
{name}2 AS (SELECT *, e - p0 * h1 - p1 * th AS gram, hy - p0 * y1 - p1 * ty AS side FROM {name}1),
{name}3 AS (SELECT *, {bend} AS g FROM {name}2),
{name}4 AS (SELECT *, q0 - p0 * g AS b0, q1 - p1 * g AS b1 FROM {name}3),
{name} AS (
  SELECT * EXCLUDE (a, d, e, p0, p1, q0, q1, gram, side, g, b0, b1), b0 AS {name}_0, b1 AS {name}_1, g AS {name}_2,
         greatest(y2 - 2 * (b0 * y1 + b1 * ty + g * hy) + b0 * b0 * n + b1 * b1 * t2 + g * g * h2
                  + 2 * b0 * b1 * t1 + 2 * b0 * g * h1 + 2 * b1 * g * th, 0) / n AS {name}_rest FROM {name}4)"""

    noise = "greatest(loose_rest, 1e-12)"
    ridge = "0" if sparse else f"{noise} / pow({scale} * top, 2)"
    bend = f"sign(side) * greatest(abs(side) - {noise} / ({scale} * top), 0) / gram" if sparse else "side / gram"
    return f"""
sums AS (
  SELECT {groups}, count(*) AS n, sum(t) AS t1, sum(t * t) AS t2, sum(h) AS h1, sum(t * h) AS th, sum(h * h) AS h2,
         sum(CAST(y AS DOUBLE)) AS y1, sum(t * y) AS ty, sum(h * y) AS hy, sum(CAST(y * y AS DOUBLE)) AS y2,
         max(abs(y)) AS top, (count(*) + sum(t * t) + sum(h * h)) / 3 AS size
  FROM {rows} GROUP BY {groups}),
{solved("loose", "sums", "n + size * 1.001e-6", "t2 + size * 1.001e-6", "h2 + size * 1.001e-6", "side / gram")},
{solved("tight", "loose", "n + size * 1e-9", f"t2 + size * 1e-9 + {noise} / (25 * top * top)", f"h2 + size * 1e-9 + {ridge}", bend)},
line AS (SELECT {groups}, n, tight_0 AS c0, tight_1 AS c1, tight_2 AS c2, sqrt(tight_rest) AS sigma FROM tight)"""


SCALED = CUTOFFS + """,
scaled AS (
  SELECT f.station, f.ds, f.y, epoch(f.ds - first) / epoch(last - first) AS t FROM frame f JOIN spans USING (station))"""

BENT = SCALED + """,
bent AS (SELECT station, t, greatest(t - 0.4, 0) AS h, y FROM scaled)"""

_OWN = (
    CUTOFFS
    + """,
ends AS (
  SELECT c.station, c.fold, c.cutoff, epoch(min(f.ds)) AS first, epoch(max(f.ds)) AS last
  FROM cutoffs c JOIN frame f ON f.station = c.station AND f.ds <= c.cutoff GROUP BY ALL),
own AS (SELECT *, (floor((first + 0.4 * (last - first)) / 86400 + 0.5) * 86400 - first) / (last - first) AS knot FROM ends),
placed AS (
  SELECT o.station, o.fold, o.cutoff, f.ds, f.y, (epoch(f.ds) - first) / (last - first) AS t,
         greatest((epoch(f.ds) - first) / (last - first) - knot, 0) AS h
  FROM own o JOIN frame f USING (station)),
seen AS (SELECT * FROM placed WHERE ds <= cutoff)"""
)
OWN_TREND = (
    _OWN
    + ","
    + _bent_line("station, fold", "seen", False)
    + f""",
held AS (
  SELECT p.*, c0 + c1 * t + c2 * h AS yhat, n,
         {WIDTH} * sqrt(sigma * sigma + 2.0 / 3 * c2 * c2 * pow(greatest(t - 1, 0), 3)) AS wide
  FROM placed p JOIN line USING (station, fold) WHERE ds > cutoff AND ds <= cutoff + INTERVAL 4 DAY)"""
)

DURATION = """date_diff('second', started_at, ended_at)"""

LIVE = HOURLY_WEATHER + """,
live AS (
  SELECT wh AS date_hour, coalesce(avg_temp, 0) AS avg_temp, coalesce(avg_pressure, 0) AS avg_pressure,
         coalesce(avg_humidity, 0) AS avg_humidity, coalesce(avg_wind_speed, 0) AS avg_wind_speed,
         coalesce(avg_pop, 0) AS avg_pop, coalesce(avg_rain_1h, 0) AS avg_rain_1h, 0.0::DOUBLE AS avg_snow_1h
  FROM hourly)"""

LATEST_STAGE = """
SELECT model_name, stage, max(version) AS version FROM (
  SELECT 'station_' || (user_id % 10) AS model_name, CAST(floor(user_id / 10) AS INTEGER) AS version,
         CASE event_type WHEN 'click' THEN 'Staging' WHEN 'error' THEN 'Staging' WHEN 'view' THEN 'Production'
              WHEN 'purchase' THEN 'Archived' ELSE 'None' END AS stage, ts
  FROM events
  QUALIFY row_number() OVER (PARTITION BY model_name, version ORDER BY ts DESC, stage DESC) = 1)
WHERE stage IN ('Staging', 'Production') GROUP BY 1, 2"""

ORACLE: dict[str, str] = {
    "hourly_inbound": _trips_per("end", "click", "num_rides_in"),
    "hourly_outbound": _trips_per("start", "view", "num_rides_out"),
    "hourly_net_flow": f"{_with(FLOWS)} SELECT {FLOW_COLUMNS} FROM flows",
    "hourly_flows_joined": f"{_with(FLOWS)} SELECT {FLOW_COLUMNS} FROM flows",
    "hourly_net_flow_dense": f"""
{_with(FLOWS)}, grid AS (
  SELECT station, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS h FROM flows GROUP BY station),
dense AS (
  SELECT station, h, coalesce(num_rides_in, 0) AS num_rides_in, coalesce(num_rides_out, 0) AS num_rides_out
  FROM grid LEFT JOIN flows USING (station, h))
SELECT {FLOW_COLUMNS} FROM dense""",
    "od_net_flow": f"""
{_with(OD)}, ins AS (
  SELECT end_station_name AS station, date_trunc('hour', ended_at) AS h, count(ride_id) AS i FROM od GROUP BY 1, 2),
outs AS (
  SELECT start_station_name AS station, date_trunc('hour', started_at) AS h, count(ride_id) AS o FROM od GROUP BY 1, 2),
both_ways AS (
  SELECT station, CAST(h AS TIMESTAMP) AS h, coalesce(i, 0) AS num_rides_in, coalesce(o, 0) AS num_rides_out
  FROM ins FULL JOIN outs USING (station, h))
SELECT {FLOW_COLUMNS} FROM both_ways""",
    "hourly_weather": f"""
{_with(HOURLY_WEATHER)}
SELECT CAST(wh AS DATE) AS weather_date, strftime(wh, '%H:00') AS weather_hour, {AVERAGES} FROM hourly""",
    "flows_with_weather": f"""
{_with(FLOWS, HOURLY_WEATHER)}
SELECT {FLOW_COLUMNS}, CAST(wh AS DATE) AS weather_date, strftime(wh, '%H:00') AS weather_hour, {AVERAGES}
FROM flows LEFT JOIN hourly ON h = wh""",
    "silver_hourly": f"""
{_with(FLOWS, HOURLY_WEATHER)}
SELECT {FLOW_COLUMNS}, CAST(wh AS DATE) AS weather_date, strftime(wh, '%H:00') AS weather_hour, {AVERAGES}
FROM flows JOIN hourly ON h = wh WHERE avg_snow_1h IS NOT NULL AND avg_rain_1h IS NOT NULL""",
    "model_frame": f"""
{_with(FLOWS, HOURLY_WEATHER)}
SELECT station, h AS ds, {REGRESSOR_AVERAGES}, num_rides_in - num_rides_out AS y
FROM flows JOIN hourly ON h = wh WHERE avg_snow_1h IS NOT NULL AND avg_rain_1h IS NOT NULL""",
    "daily_weather": f"""
{_with(WEATHER)}
SELECT CAST(dt AS DATE) AS date, round(avg(temp), 6) AS avg_temperature, round(avg(rain_1h), 6) AS avg_precipitation,
       round(avg(wind_speed), 6) AS avg_wind_speed FROM weather GROUP BY 1""",
    "station_departures": f"""
{_with(OD)} SELECT ride_id, end_station_name, started_at FROM od WHERE start_station_name = 'NATION_3'""",
    "station_touching": f"""
{_with(OD)} SELECT start_station_name, end_station_name, count(*) AS trips FROM od
WHERE start_station_name = 'NATION_3' OR end_station_name = 'NATION_3' GROUP BY 1, 2""",
    "without_round_trips": f"""
{_with(OD)} SELECT rideable_type, count(*) AS trips FROM od WHERE start_station_name <> end_station_name GROUP BY 1""",
    "trip_duration": f"""
{_with(OD)}, timed AS (SELECT {DURATION} AS s FROM od)
SELECT s AS duration_seconds,
       CASE WHEN s < 0 THEN '-' ELSE '' END || printf('%02d:%02d:%02d', abs(s) // 3600, abs(s) % 3600 // 60, abs(s) % 60)
         AS trip_duration,
       count(*) AS trips FROM timed GROUP BY 1, 2""",
    "time_parts": """
SELECT event_id, CAST(ts AS DATE) AS start_date, CAST(year(ts) * 100 + month(ts) AS INTEGER) AS start_year_month,
       CAST(year(ts) AS INTEGER) AS start_year, CAST(month(ts) AS INTEGER) AS start_month,
       CAST(hour(ts) AS INTEGER) AS start_hour, strftime(ts, '%H:00') AS start_hour_label,
       strftime(ts, '%a') AS start_day_of_week FROM events""",
    "epoch_times": f"""
{_with(STATUS)}
SELECT CAST(station AS VARCHAR) AS station_id, date_trunc('second', last_reported) AS last_reported,
       num_bikes_available,
       CASE WHEN num_bikes_available > 0 THEN 'active' ELSE 'out_of_service' END AS station_status,
       strftime(last_reported, '%Y-%m-%d %H:%M:%S') AS reported_text FROM status""",
    "period_filter": """
SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= '1996-01-01' AND o_orderdate < '1997-01-01'""",
    "recent_window": f"""
{_with(STATUS)} SELECT * FROM status WHERE last_reported BETWEEN {NOW} - INTERVAL 48 HOUR AND {NOW}""",
    "exact_hour": f"""
SELECT event_id, ts, event_type FROM events WHERE date_trunc('hour', ts) = {NOW}""",
    "monthly_trips": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(o_orderkey) AS trip_count, strftime(min(o_orderdate), '%Y-%m') AS year_month FROM orders GROUP BY 1, 2""",
    "monthly_trips_station": """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(o_orderkey) AS trip_count, strftime(min(o_orderdate), '%Y-%m') AS year_month FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1, 2""",
    "daily_trips": f"{_with(DAILY)} SELECT date, trip_count FROM daily",
    "daily_trips_station": """
SELECT CAST(o_orderdate AS DATE) AS date, count(o_orderkey) AS trip_count FROM orders
WHERE o_orderpriority = '1-URGENT' GROUP BY 1""",
    "holiday_effect": f"""
{_with(DAILY)}
SELECT dayofweek(date) IN (0, 6) OR ({_holiday("date")}) IS NOT NULL AS is_holiday,
       round(avg(trip_count), 6) AS average_trip_count FROM daily GROUP BY 1""",
    "holiday_effect_limited": f"""
{_with(DAILY)}
SELECT (dayofweek(date) IN (0, 6) AND date BETWEEN DATE '1996-01-01' AND DATE '1998-03-31')
       OR (({_holiday("date")}) IS NOT NULL AND year(date) BETWEEN 1996 AND 1998) AS is_holiday,
       round(avg(trip_count), 6) AS average_trip_count FROM daily GROUP BY 1""",
    "holiday_effect_table": f"""
{_with(DAILY)}
SELECT date IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem GROUP BY 1 HAVING count(*) % 5 = 0) AS is_holiday,
       round(avg(trip_count), 6) AS average_trip_count FROM daily GROUP BY 1""",
    "holiday_flag": f"""
{_with(DAILY)} SELECT date, trip_count, ({_holiday("date")}) IS NOT NULL AS is_holiday FROM daily""",
    "calendar": _calendar(
        "SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders", _holiday("date")
    ),
    "calendar_extended": _calendar(
        "SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem",
        _extended("date"),
    ),
    "daily_trips_weather": f"""
{_with(WEATHER)}, d AS (SELECT CAST(ts AS DATE) AS date, count(event_id) AS trip_count FROM events GROUP BY 1),
w AS (SELECT CAST(dt AS DATE) AS date, avg(temp) AS t, avg(rain_1h) AS r, avg(wind_speed) AS s FROM weather GROUP BY 1)
SELECT date, trip_count, round(t, 6) AS avg_temperature, round(r, 6) AS avg_precipitation,
       round(s, 6) AS avg_wind_speed FROM d JOIN w USING (date)""",
    "weather_correlation_zero": f"""
{_with(PAIRED)}
SELECT round(corr(trip_count, coalesce(t, 0)), 6) AS corr_avg_temperature,
       round(corr(trip_count, coalesce(r, 0)), 6) AS corr_avg_precipitation,
       round(corr(trip_count, coalesce(w, 0)), 6) AS corr_avg_wind_speed FROM paired""",
    "weather_correlation_skip": f"""
{_with(PAIRED)}
SELECT round(corr(trip_count, t), 6) AS corr_avg_temperature, round(corr(trip_count, r), 6) AS corr_avg_precipitation,
       round(corr(trip_count, w), 6) AS corr_avg_wind_speed FROM paired""",
    "count_by_bike_type": "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY 1",
    "count_by_rider_type": "SELECT c_mktsegment, count(*) AS count FROM customer GROUP BY 1",
    "status_counts": f"""
{_with(STATUS)}
SELECT CASE WHEN num_bikes_available > 0 THEN 'active' ELSE 'out_of_service' END AS station_status, count(*) AS count
FROM status GROUP BY 1""",
    "hour_by_weekday": """
SELECT CAST(hour(ts) AS INTEGER) AS hour, strftime(ts, '%a') AS day_of_week, count(*) AS count FROM events GROUP BY 1, 2""",
    "usage_matrix": "SELECT strftime(ts, '%a') AS day_of_week, "
    + ", ".join(f"nullif(count(*) FILTER (hour(ts) = {h}), 0) AS h{h:02d}" for h in range(24))
    + " FROM events GROUP BY 1",
    "weekday_weekend_by_hour": """
SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) FILTER (dayofweek(ts) NOT IN (0, 6)) AS weekday_count,
       count(*) FILTER (dayofweek(ts) IN (0, 6)) AS weekend_count,
       round(count(*) FILTER (dayofweek(ts) NOT IN (0, 6)) / 5, 6) AS weekday_per_day,
       round(count(*) FILTER (dayofweek(ts) IN (0, 6)) / 2, 6) AS weekend_per_day FROM events GROUP BY 1""",
    "od_counts_out": f"""
{_with(OD)} SELECT start_station_name AS station, end_station_name AS partner, count(ride_id) AS trip_count
FROM od WHERE start_station_name <> end_station_name GROUP BY 1, 2""",
    "od_counts_in": f"""
{_with(OD)} SELECT end_station_name AS station, start_station_name AS partner, count(ride_id) AS trip_count
FROM od WHERE start_station_name <> end_station_name AND end_station_name = 'NATION_3' GROUP BY 1, 2""",
    "top_partner_out": _top("start", "end", 1),
    "top_partners_out": _top("start", "end", 10),
    "top_partners_in": _top("end", "start", 10),
    "station_coordinates": f"""
{_with(OD)} SELECT end_station_name AS station, round(avg(end_lat), 6) AS lat, round(avg(end_lng), 6) AS lng FROM od
WHERE end_lat IS NOT NULL AND end_lng IS NOT NULL GROUP BY 1""",
    "null_profile": f"{_with(WEATHER)} SELECT "
    + ", ".join(
        f"count(*) - count({c}) AS {c}"
        for c in ["dt", "temp", "feels_like", "pressure", "humidity", "wind_speed", "pop", "snow_1h", "rain_1h"]
    )
    + " FROM weather",
    "duplicate_check": """
SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows,
       count(*) <> count(DISTINCT (l_orderkey, l_linenumber)) AS has_duplicates FROM lineitem""",
    "dedup_weather": f"""
{_with(WEATHER)}
SELECT date_trunc('hour', dt) AS hour, dt, round(temp, 6) AS temp, pressure, round(snow_1h, 6) AS snow_1h,
       round(rain_1h, 6) AS rain_1h FROM weather
QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', dt) ORDER BY dt, weather.temp, pressure, humidity) = 1""",
    "unique_values": "SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem",
    "complete_rows": f"""
{_with(WEATHER)} SELECT dt, round(temp, 6) AS temp, round(snow_1h, 6) AS snow_1h, round(rain_1h, 6) AS rain_1h
FROM weather WHERE snow_1h IS NOT NULL AND rain_1h IS NOT NULL""",
    "latest_as_of": f"""
{_with(STATUS)} SELECT station, last_reported, num_bikes_available FROM status WHERE last_reported <= {NOW}
QUALIFY row_number() OVER (PARTITION BY station ORDER BY last_reported DESC, num_bikes_available DESC) = 1""",
    "latest_rows": f"{_with(STATUS)} SELECT * FROM status ORDER BY last_reported DESC, event_id DESC LIMIT 100",
    "status_with_weather": f"""
{_with(STATUS, LIVE)}
SELECT date_trunc('hour', last_reported) AS date_hour, event_id, station, last_reported, num_bikes_available,
       {REGRESSOR_AVERAGES}
FROM status LEFT JOIN live ON live.date_hour = date_trunc('hour', last_reported)""",
    "inference_frame": f"""
{_with(STATUS, LIVE)}, joined AS (
  SELECT event_id, station, last_reported AS ds, num_bikes_available, live.*
  FROM status LEFT JOIN live ON live.date_hour = date_trunc('hour', last_reported)
  WHERE last_reported >= {NOW} - INTERVAL 72 HOUR)
SELECT event_id, station, ds, num_bikes_available, """
    + ", ".join(
        f"round(last_value(avg_{r} IGNORE NULLS) OVER w, 6) AS avg_{r}" for r in REGRESSORS
    )
    + """ FROM joined
WINDOW w AS (PARTITION BY station ORDER BY ds, num_bikes_available ROWS UNBOUNDED PRECEDING)""",
    "forward_fill": f"""
{_with(STATUS, HOURLY_WEATHER)}, joined AS (
  SELECT event_id, station, last_reported, num_bikes_available, avg_rain_1h AS r, avg_snow_1h AS s
  FROM status LEFT JOIN hourly ON wh = date_trunc('hour', last_reported))
SELECT event_id, station, last_reported, num_bikes_available,
       round(last_value(r IGNORE NULLS) OVER w, 6) AS avg_rain, round(last_value(s IGNORE NULLS) OVER w, 6) AS avg_snow
FROM joined WINDOW w AS (PARTITION BY station ORDER BY last_reported, event_id ROWS UNBOUNDED PRECEDING)""",
    "running_inventory": f"""
{_with(FITTED)}
SELECT station, ds, round(yhat, 6) + 0.0 AS yhat, 50 + CAST(sum(round_even(yhat, 0)) OVER (
         PARTITION BY station ORDER BY ds ROWS UNBOUNDED PRECEDING) AS BIGINT) AS num_bikes_available FROM fitted""",
    "running_bikes": f"""
{_with(STATUS)}
SELECT *, CAST(sum(num_bikes_available) OVER (
  PARTITION BY station ORDER BY last_reported, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS bikes_so_far
FROM status""",
    "stock_status": f"""
{_with(STATUS)}, s AS (SELECT event_id, num_bikes_available AS bikes FROM status)
SELECT event_id, bikes AS num_bikes_available, {STOCK_MESSAGE} AS status_message, bikes >= 105 AS is_full FROM s""",
    "forecast_vs_actual": f"""
{_with(FITTED, HOURLY_STATUS)}, moved AS (
  SELECT station, ds, yhat, 50 + CAST(sum(round_even(yhat, 0)) OVER (
           PARTITION BY station ORDER BY ds ROWS UNBOUNDED PRECEDING) AS BIGINT) AS x FROM fitted)
SELECT station, ds, round(yhat, 6) + 0.0 AS yhat, x AS num_bikes_available_x,
       num_bikes_available AS num_bikes_available_y, x - num_bikes_available AS residual
FROM moved JOIN hourly_status USING (station, ds)""",
    "gold_inventory": f"""
{_with(GOLD)}
SELECT station, stage, ds, bikes AS num_bikes_available_x, seen AS num_bikes_available_y, bikes - seen AS residual,
       {STOCK_MESSAGE} AS status_message, bikes >= 105 AS is_full FROM gold""",
    "compare_stages": f"""
{_with(GOLD)}, r AS (SELECT station, stage, CAST(bikes AS DOUBLE) AS x, CAST(bikes - seen AS DOUBLE) AS e FROM gold)
SELECT station, stage, count(*) AS rows, round(avg(e), 6) AS bias, round(avg(abs(e)), 6) AS mae,
       round(sqrt(avg(e * e)), 6) AS rmse, round(regr_slope(e, x), 6) AS slope,
       round(regr_intercept(e, x), 6) AS intercept FROM r GROUP BY 1, 2""",
    "future_frame": f"{_with(FRAME, FUTURE)} SELECT station, ds, is_future FROM future",
    "attach_regressors": f"""
{_with(FRAME, FUTURE, HOURLY_WEATHER)}, known AS (
  SELECT station, ds, hourly.* FROM frame JOIN hourly ON wh = ds
  WHERE avg_snow_1h IS NOT NULL AND avg_rain_1h IS NOT NULL),
joined AS (SELECT f.station, f.ds, f.is_future, known.* EXCLUDE (station, ds) FROM future f
           LEFT JOIN known ON known.station = f.station AND known.ds = f.ds)
SELECT station, ds, is_future, """
    + ", ".join(f"round(last_value(avg_{r} IGNORE NULLS) OVER w, 6) AS avg_{r}" for r in REGRESSORS)
    + " FROM joined WINDOW w AS (PARTITION BY station ORDER BY ds ROWS UNBOUNDED PRECEDING)",
    "seasonal_profile": f"""
{_with(PROFILE)}
SELECT station, ['Sun', 'Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat'][dow + 1] AS day_of_week, CAST(hh AS INTEGER) AS hour,
       round(yhat, 6) + 0.0 AS yhat, round(yhat_lower, 6) + 0.0 AS yhat_lower, round(yhat_upper, 6) + 0.0 AS yhat_upper
FROM profile""",
    "profile_forecast": f"""
{_with(PROFILE, FUTURE)}
SELECT f.station, f.ds, f.is_future, round(yhat, 6) + 0.0 AS yhat, round(yhat_lower, 6) + 0.0 AS yhat_lower,
       round(yhat_upper, 6) + 0.0 AS yhat_upper
FROM future f LEFT JOIN profile p ON p.station = f.station AND p.dow = dayofweek(f.ds) AND p.hh = hour(f.ds)""",
    "cv_folds": f"""
{_with(CUTOFFS)}
SELECT c.station, c.fold, c.cutoff, count(*) FILTER (f.ds <= c.cutoff) AS train_rows,
       count(*) FILTER (f.ds > c.cutoff AND f.ds <= c.cutoff + INTERVAL 4 DAY) AS test_rows
FROM cutoffs c JOIN frame f ON f.station = c.station GROUP BY 1, 2, 3""",
    "cv_predictions": f"""
{_with(CV)}
SELECT station, fold, ds, y, round(yhat, 6) + 0.0 AS yhat, round(yhat_lower, 6) + 0.0 AS yhat_lower,
       round(yhat_upper, 6) + 0.0 AS yhat_upper FROM cv""",
    "cv_metrics": f"{_with(CV)} SELECT station, {METRICS} FROM cv GROUP BY 1",
    "cv_metrics_overall": f"{_with(CV)} SELECT {METRICS} FROM cv",
    "best_params": f"""
{_with(CV)}, sized AS (
  SELECT station, shrink, avg(abs(yhat * shrink - y)) AS mae
  FROM cv CROSS JOIN (VALUES (0.0::DOUBLE), (0.25), (0.5), (0.75), (1.0)) v(shrink) GROUP BY 1, 2)
SELECT station, shrink, round(mae, 6) AS mae FROM sized
QUALIFY row_number() OVER (PARTITION BY station ORDER BY sized.mae, shrink) = 1""",
    "param_grid": """
SELECT s.station, cps.v AS changepoint_prior_scale, sps.v AS seasonality_prior_scale,
       hps.v AS holidays_prior_scale, sm.v AS seasonality_mode
FROM (SELECT DISTINCT user_id % 10 AS station FROM events) s
CROSS JOIN (SELECT unnest([0.001, 0.01, 0.1, 0.5]::DOUBLE[]) AS v) cps
CROSS JOIN (SELECT unnest([0.01, 0.1, 1.0, 10.0]::DOUBLE[]) AS v) sps
CROSS JOIN (SELECT unnest([0.01, 0.1, 1.0, 10.0]::DOUBLE[]) AS v) hps
CROSS JOIN (SELECT unnest(['additive', 'multiplicative']) AS v) sm""",
    "ridge_trend_forecast": f"""
{_with(SCALED, FUTURE, _ridge_line("station", "scaled"))}
SELECT f.station, f.ds, f.is_future, round(c0 + c1 * epoch(f.ds - first) / epoch(last - first), 6) + 0.0 AS yhat
FROM future f JOIN spans USING (station) JOIN line USING (station)""",
    "ridge_trend_cv": f"""
{_with(SCALED)}, seen AS (
  SELECT c.station, c.fold, t, y FROM cutoffs c JOIN scaled s ON s.station = c.station AND s.ds <= c.cutoff),
{_ridge_line("station, fold", "seen")}
SELECT s.station, c.fold, s.ds, s.y, round(c0 + c1 * s.t, 6) + 0.0 AS yhat, n AS train_rows
FROM cutoffs c JOIN scaled s ON s.station = c.station AND s.ds > c.cutoff AND s.ds <= c.cutoff + INTERVAL 4 DAY
JOIN line l ON l.station = c.station AND l.fold = c.fold""",
    "forecast_residuals": f"""
{_with(FITTED)} SELECT station, ds, round(yhat, 6) + 0.0 AS yhat, y, round(yhat - y, 6) + 0.0 AS residual FROM fitted""",
    "residual_trend": f"""
{_with(CV)}
SELECT station, round(regr_slope(residual, yhat), 6) AS slope, round(regr_intercept(residual, yhat), 6) AS intercept,
       round(regr_r2(residual, yhat), 6) AS r2, CAST(regr_count(residual, yhat) AS BIGINT) AS pairs
FROM cv GROUP BY 1""",
    "residual_distribution": f"{_with(CV)} SELECT station, "
    + ", ".join(f"round(quantile_cont(residual, {p / 100}), 6) + 0.0 AS p{p}" for p in (0, 25, 50, 75, 100))
    + " FROM cv GROUP BY 1",
    "residual_histogram": f"""
{_with(CV)}
SELECT station, CAST(CASE WHEN residual < -2.05 THEN 0 WHEN residual >= 2.05 THEN 11
       ELSE floor(10 * (residual + 2.05) / 4.1) + 1 END AS BIGINT) AS bin, count(*) AS count FROM cv GROUP BY 1, 2""",
    "price_percentiles": """
SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.05), 6) AS p5,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.95), 6) AS p95,
       round(quantile_cont(l_quantity, 0.5), 6) AS quantity_p50 FROM lineitem GROUP BY 1""",
    "percentiles_with_nan": """
WITH odd AS (
  SELECT l_returnflag, CASE l_linenumber WHEN 1 THEN 4 WHEN 2 THEN 1 WHEN 3 THEN 3 ELSE 2 END AS place, l_quantity AS v
  FROM lineitem),
ranked AS (
  SELECT l_returnflag, CASE place WHEN 4 THEN 'NaN' WHEN 1 THEN '-Infinity' WHEN 3 THEN 'Infinity' ELSE CAST(v AS VARCHAR) END AS t,
         row_number() OVER (PARTITION BY l_returnflag ORDER BY place, v) - 1 AS r,
         count(*) OVER (PARTITION BY l_returnflag) - 1 AS n FROM odd)
SELECT l_returnflag, max(CASE WHEN r = 0 THEN t END) AS p0, max(CASE WHEN r = floor(n * 0.2) THEN t END) AS p20,
       max(CASE WHEN r = floor(n * 0.45) THEN t END) AS p45, max(CASE WHEN r = floor(n * 0.7) THEN t END) AS p70,
       max(CASE WHEN r = n THEN t END) AS p100
FROM ranked GROUP BY 1""",
    "registry_latest": LATEST_STAGE,
    "registry_lifecycle": f"""
{_with(CV)}
SELECT 'station_' || station AS model_name, stage, CAST(version AS INTEGER) AS version
FROM (SELECT DISTINCT station FROM cv) CROSS JOIN (VALUES ('Production', 1), ('Staging', 2)) v(stage, version)""",
    "csv_round_trip": """
SELECT CAST(event_id AS VARCHAR) AS ride_id,
       CASE WHEN event_type = 'view' THEN CAST(user_id % 10 AS VARCHAR) END AS start_station_name,
       CASE WHEN event_type = 'click' THEN CAST(user_id % 10 AS VARCHAR) END AS end_station_name,
       CASE WHEN event_type = 'view' THEN ts END AS started_at, CASE WHEN event_type = 'click' THEN ts END AS ended_at
FROM events WHERE event_type IN ('click', 'view')""",
    "csv_inferred": "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders",
    "clustered_round_trip": """
SELECT l_returnflag, count(*) AS trips, sum(l_quantity) AS quantity FROM lineitem
WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '1996-07-01' GROUP BY 1""",
    "balanced_round_trip": f"""
{_with(WEATHER)} SELECT dt, round(temp, 6) AS temp, pressure, round(rain_1h, 6) AS rain_1h FROM weather""",
    "table_detail": """
SELECT count(*) AS num_rows, CAST(11 AS INTEGER) AS num_columns, true AS has_bytes FROM lineitem""",
    "stream_status": f"""
{_with(STATUS)}
SELECT CAST(station AS VARCHAR) AS station_id, date_trunc('second', last_reported) AS last_reported,
       num_bikes_available,
       CASE WHEN num_bikes_available > 0 THEN 'active' ELSE 'out_of_service' END AS station_status FROM status""",
    "stream_weather": f"""
{_with(WEATHER)}
SELECT date_trunc('second', dt) AS dt, round(temp, 6) AS temp, pressure, humidity, round(wind_speed, 6) AS wind_speed,
       round(pop, 6) AS pop, round(rain_1h, 6) AS rain_1h FROM weather""",
    "stream_dedup": f"""
{_with(STATUS)}
SELECT DISTINCT CAST(station AS VARCHAR) AS station_id, date_trunc('second', last_reported) AS last_reported
FROM status""",
}
ORACLE["weather_csv"] = ORACLE["stream_weather"].replace(
    "SELECT date_trunc", "SELECT CAST(NULL AS DOUBLE) AS snow_1h, CAST(NULL AS VARCHAR) AS main, date_trunc"
)
ORACLE["published_table"] = """
SELECT CAST(user_id % 10 AS VARCHAR) AS station_id, count(*) AS count FROM events WHERE event_type = 'purchase' GROUP BY 1"""
ORACLE["stream_duplicate_check"] = f"""
{_with(STATUS)}
SELECT 2 * count(*) AS total_rows, count(DISTINCT (station, date_trunc('second', last_reported))) AS distinct_rows,
       true AS has_duplicates FROM status"""
ORACLE["silver_station"] = ORACLE["silver_hourly"] + " AND station = 3"
ORACLE["csv_union"] = ORACLE["csv_round_trip"]
ORACLE["stream_dedup_batches"] = ORACLE["stream_dedup"]
ORACLE["stream_silver"] = ORACLE["silver_hourly"]
ORACLE["ingest_twice"] = ORACLE["csv_round_trip"]
ORACLE["stream_counts"] = f"""
{_with(STATUS)}
SELECT CAST(0 AS INTEGER) AS batch, count(*) AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM status"""
ORACLE["managed_table"] = f"""
{_with(STATUS)}
SELECT CASE WHEN num_bikes_available > 0 THEN 'active' ELSE 'out_of_service' END AS station_status, count(*) AS count
FROM status GROUP BY 1"""
ORACLE["table_files"] = """
SELECT CAST(3 AS BIGINT) AS num_files, count(*) AS num_rows, CAST(2 AS INTEGER) AS num_columns FROM lineitem"""
ORACLE["ordered_months"] = """
SELECT strftime(min(o_orderdate), '%Y-%m') AS year_month, count(o_orderkey) AS trip_count,
       row_number() OVER (ORDER BY min(o_orderdate)) - 1 AS place
FROM orders GROUP BY year(o_orderdate), month(o_orderdate)"""
ORACLE["first_rows"] = "SELECT least(count(*), 100) AS rows FROM orders"
ORACLE["unreadable_cells"] = f"""
{_with(WEATHER)}, seconds AS (SELECT CAST(epoch(date_trunc('second', dt)) AS BIGINT) AS s FROM weather)
SELECT v.name AS column, count(*) AS rows,
       count(*) FILTER (WHERE (v.name = 'dt' AND s % 5 = 0) OR (v.name = 'temp' AND s % 3 = 0)) AS unreadable
FROM seconds CROSS JOIN (VALUES ('dt'), ('temp'), ('pressure')) v(name) GROUP BY 1"""
ORACLE["sparse_trend_forecast"] = f"""
{_with(BENT, FUTURE, _bent_line("station", "bent", True))}, timed AS (
  SELECT f.*, epoch(f.ds - first) / epoch(last - first) AS t FROM future f JOIN spans USING (station))
SELECT station, ds, is_future, round(c0 + c1 * t + c2 * greatest(t - 0.4, 0), 6) + 0.0 AS yhat
FROM timed JOIN line USING (station)"""
ORACLE["sparse_trend_models"] = f"""
{_with(BENT)}, settings AS (
  SELECT b.*, scale FROM bent b CROSS JOIN (VALUES (0.001::DOUBLE), (0.02), (0.5)) v(scale)),
{_bent_line("station, scale", "settings", True, "scale")}
SELECT station, scale AS changepoint_prior_scale, round(c0, 6) + 0.0 AS level, round(c1, 6) + 0.0 AS slope,
       round(c2, 6) + 0.0 AS bend, round(sigma, 6) AS sigma FROM line"""
ORACLE["sparse_grid_search"] = f"""
{_with(_OWN)}, settings AS (SELECT s.*, scale FROM seen s CROSS JOIN (VALUES (0.001::DOUBLE), (0.02), (0.5)) v(scale)),
{_bent_line("station, fold, scale", "settings", True, "scale")},
held AS (
  SELECT p.station, l.scale, p.y, c0 + c1 * t + c2 * h AS yhat,
         {WIDTH} * sqrt(sigma * sigma + 2.0 / 3 * c2 * c2 * pow(greatest(t - 1, 0), 3)) AS wide
  FROM placed p JOIN line l USING (station, fold) WHERE ds > cutoff AND ds <= cutoff + INTERVAL 4 DAY),
scores AS (
  SELECT station, scale, avg(pow(yhat - y, 2)) AS mse, sqrt(avg(pow(yhat - y, 2))) AS rmse, round(avg(abs(yhat - y)), 9) AS mae,
         median(abs((yhat - y) / y)) FILTER (y <> 0) AS mdape,
         avg(CASE WHEN y BETWEEN yhat - wide AND yhat + wide THEN 1.0 ELSE 0.0 END) AS coverage
  FROM held GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY station ORDER BY round(avg(abs(yhat - y)), 9), scale) = 1)
SELECT station, scale AS changepoint_prior_scale, round(mse, 6) AS mse, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
       round(mdape, 6) AS mdape, round(coverage, 6) AS coverage FROM scores"""
ORACLE["own_trend_cv"] = f"""
{_with(OWN_TREND)} SELECT station, fold, ds, y, round(yhat, 6) + 0.0 AS yhat, n AS train_rows FROM held"""
ORACLE["forecast_intervals"] = f"""
{_with(OWN_TREND)}
SELECT station, fold, ds, round(yhat - wide, 6) + 0.0 AS yhat_lower, round(yhat + wide, 6) + 0.0 AS yhat_upper FROM held"""
ORACLE["interval_coverage"] = f"""
{_with(OWN_TREND)}
SELECT CAST(ceil(epoch(ds - cutoff) / 86400) AS INTEGER) AS horizon_days, count(*) AS rows,
       round(avg(CASE WHEN y BETWEEN yhat - wide AND yhat + wide THEN 1.0 ELSE 0.0 END), 6) AS coverage,
       round(avg(2 * wide), 6) AS width FROM held GROUP BY 1"""
ORACLE["asof_weather"] = f"""
{_with(STATUS, WEATHER)}, readings AS (
  SELECT dt, temp, pressure, rain_1h FROM weather
  QUALIFY row_number() OVER (PARTITION BY dt ORDER BY temp DESC, pressure DESC, rain_1h DESC NULLS LAST) = 1),
matched AS (
  SELECT s.*, w.dt, w.temp, w.pressure, w.rain_1h, s.last_reported <= w.dt + INTERVAL 30 MINUTE AS near
  FROM status s ASOF LEFT JOIN readings w ON s.last_reported >= w.dt)
SELECT event_id, station, last_reported, num_bikes_available, CASE WHEN near THEN dt END AS dt,
       round(CASE WHEN near THEN temp END, 6) AS temp, CASE WHEN near THEN pressure END AS pressure,
       round(CASE WHEN near THEN rain_1h END, 6) AS rain_1h FROM matched"""
ORACLE["asof_stock"] = f"""
{_with(STATUS)}, reports AS (
  SELECT station, last_reported, max(num_bikes_available) AS num_bikes_available FROM status GROUP BY 1, 2)
SELECT event_id AS ride_id, user_id % 10 AS start_station_name, ts AS started_at,
       r.last_reported AS seen_last_reported, r.num_bikes_available AS seen_num_bikes_available
FROM events e ASOF LEFT JOIN reports r ON e.user_id % 10 = r.station AND e.ts >= r.last_reported"""
_BOUNDED = f"""WITH RECURSIVE {_with(FITTED).lstrip()[5:]}, numbered AS (
  SELECT station, ds, yhat * 3 AS yhat, CAST(round_even(yhat * 3, 0) AS BIGINT) AS change,
         row_number() OVER (PARTITION BY station ORDER BY ds) AS place FROM fitted),
steps AS (
  SELECT station, CAST(0 AS BIGINT) AS place, CAST(NULL AS TIMESTAMP) AS ds, CAST(NULL AS DOUBLE) AS yhat,
         CAST(50 AS BIGINT) AS bikes, CAST(50 AS BIGINT) AS wish FROM (SELECT DISTINCT station FROM numbered)
  UNION ALL
  SELECT n.station, n.place, n.ds, n.yhat, least(greatest(s.bikes + n.change, 0), 53), s.bikes + n.change
  FROM steps s JOIN numbered n ON n.station = s.station AND n.place = s.place + 1)"""
ORACLE["bounded_inventory"] = f"""
{_BOUNDED}
SELECT station, ds, round(yhat, 6) + 0.0 AS yhat, bikes AS num_bikes_available, greatest(-wish, 0) AS lost_departures,
       greatest(wish - 53, 0) AS lost_arrivals, {STOCK_MESSAGE.replace("105", "53")} AS status_message, bikes >= 53 AS is_full
FROM steps WHERE place > 0"""
ORACLE["stage_difference"] = f"""
{_with(GOLD)}, pairs AS (
  SELECT station, epoch(ds) AS sec, avg(abs(bikes - seen)) FILTER (stage = 'Staging')
         - avg(abs(bikes - seen)) FILTER (stage = 'Production') AS d FROM gold GROUP BY station, ds),
digests AS (
  SELECT station, d, n, md5(station || '|' || CAST(CAST(sec AS BIGINT) AS VARCHAR) || '|' || n) AS m
  FROM pairs CROSS JOIN range(8) r(n) WHERE d IS NOT NULL),
spots AS (
  SELECT station, d, n * 8 + k AS r, CAST('0x' || substr(m, CAST(4 * k + 1 AS BIGINT), 4) AS INTEGER) AS s
  FROM digests CROSS JOIN range(8) r(k)),
weights AS (
  SELECT station, d, r, len(list_filter([24109, 48219, 60273, 64292, 65296, 65497, 65531, 65535], lambda e: s >= e)) AS w FROM spots),
draws AS (SELECT station, r, sum(w * d) / sum(w) AS v FROM weights GROUP BY 1, 2 HAVING sum(w) > 0),
listed AS (SELECT station, list_sort(list(v)) AS vs FROM draws GROUP BY 1),
means AS (SELECT station, count(*) AS pairs, avg(d) AS difference FROM pairs WHERE d IS NOT NULL GROUP BY 1)
SELECT station, pairs, round(difference, 6) + 0.0 AS difference,
       round(vs[1 + CAST(floor((len(vs) - 1) * 0.05) AS BIGINT)], 6) + 0.0 AS low,
       round(vs[1 + CAST(ceil((len(vs) - 1) * 0.95) AS BIGINT)], 6) + 0.0 AS high,
       round(len(list_filter(vs, lambda x: x < 0)) / len(vs), 6) AS better
FROM means JOIN listed USING (station)"""
ORACLE["ingest_report"] = ORACLE["unreadable_cells"]
ORACLE["regression_terms"] = f"""
{_with(FRAME)}, t AS (
  SELECT station, ds, epoch(ds) / 86400.0 * 2 * pi() AS turns, CAST(ds AS DATE) AS day,
         CAST(epoch(ds) - min(epoch(ds)) OVER w AS DOUBLE) / greatest(max(epoch(ds)) OVER w - min(epoch(ds)) OVER w, 1) AS part
  FROM frame WINDOW w AS (PARTITION BY station))
SELECT station, ds, round(sin(turns / 7), 6) + 0.0 AS sin_week, round(cos(turns / 7), 6) + 0.0 AS cos_week,
       round(sin(turns), 6) + 0.0 AS sin_day, round(cos(turns), 6) + 0.0 AS cos_day,
       CASE WHEN {_extended("day")} IS NOT NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS holidays,
       round(part, 6) + 0.0 AS trend, round(greatest(part - 0.4, 0), 6) + 0.0 AS bend
FROM t"""
