"""Plain SQL for each registered query, over the same test tables.

Written apart from the DataFrame code: the first observed stop is found with a
subquery instead of a join, timetable seconds come from the line number instead of
the time text, and snapshots are recomputed instead of read back.
"""

from __future__ import annotations

from tramline.plans.registry import AS_OF, REPORT_DAY, WATCHED
from tramline.plans.roles import STAMPS

_VISITS = """
visits AS (
  SELECT sign * l_orderkey AS trip_id, l_linenumber AS stop_sequence,
         MIN(l_suppkey) AS stop_id, MIN(l_partkey) AS part,
         CAST(82800 + (l_linenumber - 1) * 1800 AS BIGINT) AS sec
  FROM lineitem CROSS JOIN (VALUES (1), (-1)) g(sign)
  WHERE sign = 1 OR l_orderkey % 13 = 0
  GROUP BY sign, l_orderkey, l_linenumber
)"""

_SEEN = (
    _VISITS
    + """,
seen AS (
  SELECT v.*, shift, o.o_custkey AS route_id, CAST(o.o_orderkey % 2 AS INTEGER) AS direction_id,
         CAST(EPOCH(DATE_TRUNC('week', o.o_orderdate)) AS BIGINT) + v.sec + v.part % 1800 - 600 AS at_sec,
         v.part % 17 <> 0 AS has_arrival, v.part % 13 <> 0 AS has_departure
  FROM visits v JOIN orders o ON o.o_orderkey = abs(v.trip_id)
  CROSS JOIN (VALUES (1), (2)) c(copy) CROSS JOIN (VALUES (0), (50), (-50)) s(shift)
  WHERE (copy = 1 OR v.part % 37 = 0)
    AND (shift = 0 OR v.part % 23 = 0 AND shift = CASE WHEN v.part % 46 = 0 THEN -50 ELSE 50 END)
),
feed AS (
  SELECT trip_id, route_id, direction_id, stop_id, stop_sequence + shift AS stop_sequence, sec,
         CASE WHEN has_arrival THEN at_sec END AS arrival_time,
         CASE WHEN has_departure THEN at_sec + 30 END AS departure_time
  FROM seen
)"""
)

_TIMES = """
timetable AS (
  SELECT trip_id, stop_sequence, stop_id, CASE WHEN COALESCE(part, 1) % 29 <> 0 THEN sec END AS sec
  FROM visits CROSS JOIN (VALUES (1), (2)) c(copy)
  WHERE copy = 1 OR part % 31 = 0
)"""

_RELATIVE = (
    _SEEN
    + f""",
{_TIMES.strip()},
scheduled AS (
  SELECT f.trip_id, f.stop_sequence, t.stop_id, f.arrival_time AS arr, t.sec
  FROM feed f JOIN timetable t ON t.trip_id = f.trip_id AND t.stop_sequence = f.stop_sequence
  WHERE t.sec IS NOT NULL
),
origins AS (
  SELECT trip_id, arr - sec AS origin FROM scheduled s
  WHERE arr IS NOT NULL
    AND stop_sequence = (SELECT MIN(stop_sequence) FROM feed f WHERE f.trip_id = s.trip_id)
),
events_sec AS (
  SELECT trip_id, stop_sequence, stop_id, arr, origin + sec AS plan, arr - origin - sec AS late
  FROM scheduled JOIN origins USING (trip_id)
)"""
)


def _to_paris(seconds: str) -> str:
    return f"((make_timestamp({seconds} * 1000000) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris')"


_SERVICE_DAY = (
    _SEEN
    + f""",
{_TIMES.strip()},
placed AS (
  SELECT f.trip_id, f.stop_sequence, t.stop_id, t.sec, f.arrival_time AS arr,
         CAST({_to_paris("f.arrival_time")} AS DATE) AS local_day
  FROM feed f JOIN timetable t ON t.trip_id = f.trip_id AND t.stop_sequence = f.stop_sequence
  WHERE f.arrival_time IS NOT NULL AND t.sec IS NOT NULL
),
planned AS (
  SELECT *, CAST(EPOCH(((CAST(local_day AS TIMESTAMP) + to_seconds(sec)) AT TIME ZONE 'Europe/Paris')
                       AT TIME ZONE 'UTC') AS BIGINT) AS plan
  FROM placed
),
events_sec AS (
  SELECT trip_id, stop_sequence, stop_id, sec, local_day, arr, plan, arr - plan AS late FROM planned
)"""
)

_VEHICLES = """
positions AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events
),
vehicles AS (
  SELECT user_id AS trip_id, concat_ws('-', event_type, CAST(user_id % 7 AS VARCHAR)) AS route_id, value AS latitude, k AS longitude, event_id,
         CASE WHEN k <> 0 THEN CAST(FLOOR(EPOCH_US(ts) / 1000000) AS BIGINT) END AS at_sec
  FROM positions
)"""

_STOPS = """
places AS (
  SELECT s_suppkey AS stop_id, s_name AS stop_name, s_acctbal AS stop_lat,
         CAST(s_nationkey AS DOUBLE) AS stop_lon
  FROM supplier
  UNION ALL SELECT -1, 'Unused', 43.5, 7.25
)"""

_TRIPS = """
trips AS (
  SELECT o_orderkey AS trip_id, CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS route_id
  FROM orders
)"""

_ROUTES = """
routes AS (
  SELECT c_custkey AS route_id, c_mktsegment AS route_short_name, c_name AS route_long_name
  FROM customer
  UNION ALL SELECT NULL, 'none', 'No route'
)"""

_MEAN = "CAST(SUM(late) AS DOUBLE) / COUNT(late) / 60.0"
_AVG = f"ROUND({_MEAN}, 2) AS avg_delay_min"
_MINUTE = f"DATE_TRUNC('minute', {_to_paris('arr')})"
_EVENT = """trip_id, stop_sequence, stop_id, make_timestamp(arr * 1000000) AS arrival_dt_utc,
       make_timestamp(plan * 1000000) AS scheduled_ts_utc, late / 60.0 AS delay_min"""
_ON_DAY = f"CAST(make_timestamp(arr * 1000000) AS DATE) = DATE '{REPORT_DAY}'"

# A run sees the trips whose number leaves its place, or the one before, as remainder.
_RUNS = ", ".join(
    f"({i}, '{s}'), ({(i + len(STAMPS) - 1) % len(STAMPS)}, '{s}')" for i, s in enumerate(STAMPS)
)
_RUN_EVENTS = (
    _RELATIVE
    + f""",
runs(covered, stamp) AS (VALUES {_RUNS}),
run_events AS (
  SELECT r.stamp, e.* FROM events_sec e JOIN runs r ON r.covered = (e.trip_id % {len(STAMPS)} + {len(STAMPS)}) % {len(STAMPS)}
)"""
)
_RUN_MINUTES = (
    _RUN_EVENTS
    + f""",
minutes AS (
  SELECT stamp, {_MINUTE} AS minute_ts, {_AVG} FROM run_events GROUP BY 1, 2
)"""
)
_RUN_STOPS = (
    _RUN_EVENTS
    + f""",
{_STOPS.strip()},
stop_runs AS (
  SELECT CAST(p.stop_id AS VARCHAR) AS stop_id, p.stop_name, p.stop_lat, p.stop_lon,
         strptime(s.stamp, '%Y%m%d_%H%M%S') AS snapshot_ts_temps,
         {_AVG}
  FROM places p CROSS JOIN (SELECT DISTINCT stamp FROM runs) s
  LEFT JOIN run_events e ON e.stop_id = p.stop_id AND e.stamp = s.stamp
  GROUP BY ALL
)"""
)
_IN_RANGE = (
    "snapshot_ts_temps >= TIMESTAMP '2025-09-12' AND snapshot_ts_temps < TIMESTAMP '2025-09-20'"
)
_SELECTED = "(stamp LIKE '2025091%' AND stamp >= '20250912' OR stamp LIKE '20250922%')"

_HEATMAP = """SELECT strftime(minute_ts, '%Y-%m-%d') AS jour_date, strftime(minute_ts, '%H') AS heure,
  ROUND(CAST(SUM(CAST(CAST(avg_delay_min AS VARCHAR) AS DECIMAL(38, 18))) AS DOUBLE)
    / COUNT(avg_delay_min), 2) AS avg_delay_min,
  COUNT(*) AS nb_events
FROM minutes WHERE minute_ts IS NOT NULL AND {rows} GROUP BY 1, 2"""

_BEFORE_AS_OF = (
    f"minute_ts <= (TIMESTAMP '{AS_OF}' AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Paris'"
)

# Time of the first label, which the daily run carries.
_LABEL_TIME = f"{STAMPS[0][:4]}-{STAMPS[0][4:6]}-{STAMPS[0][6:8]} {STAMPS[0][9:11]}:00:00"

_POSITIONS = f"""SELECT v.trip_id, v.route_id, v.latitude, v.longitude,
  {_to_paris("v.at_sec")} AS timestamp_paris, ROUND(e.late / 60.0, 2) AS delay_min
FROM vehicles v LEFT JOIN events_sec e ON e.trip_id = v.trip_id"""

_STOP_AVERAGE = f"""SELECT p.stop_id, p.stop_name, p.stop_lat, p.stop_lon, {_AVG}
FROM places p LEFT JOIN {{events}} e ON e.stop_id = p.stop_id
GROUP BY p.stop_id, p.stop_name, p.stop_lat, p.stop_lon"""

_HMS = r"\s*([+-]?[0-9]+)\s*:\s*([+-]?[0-9]+)\s*:\s*([+-]?[0-9]+)\s*"


def _timetable(columns: str) -> str:
    clock = "printf('%02d:%02d:%02d', ({s}) // 3600, ({s}) // 60 % 60, ({s}) % 60)"
    return f"""WITH {_VISITS},
{_TIMES.strip()},
times AS (
  SELECT *, CASE WHEN sec IS NOT NULL THEN {clock.format(s="sec")} END AS arrival_time,
    CASE WHEN sec IS NOT NULL THEN {clock.format(s="sec + 30")} END AS departure_time
  FROM timetable
) SELECT {columns} FROM times"""


# Queries that take another way to the same rows.
_SAME = {
    "avg_delay_by_minute_weighted": "avg_delay_by_minute",
    "avg_delay_by_stop_weighted": "avg_delay_by_stop",
    "route_delay_with_counts_weighted": "route_delay_with_counts",
    "punctuality_rate_weighted": "punctuality_rate",
    "one_row_preview": "punctuality_rate",
}


def oracle_sql() -> dict[str, str]:
    found = _statements()
    return found | {name: found[same] for name, same in _SAME.items()}


def _statements() -> dict[str, str]:
    return {
        "hhmmss_to_seconds_column": f"""
WITH texts AS (
  SELECT l_orderkey, l_linenumber, l_partkey % 9 AS kind,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS h, CAST(l_linenumber AS VARCHAR) AS m,
         CAST(l_suppkey AS VARCHAR) AS s
  FROM lineitem
), built AS (
  SELECT l_orderkey, l_linenumber, CASE kind
      WHEN 0 THEN h || ':' || m
      WHEN 1 THEN h || ':' || m || ':' || s || '.5'
      WHEN 2 THEN ''
      WHEN 3 THEN 'x:' || m || ':' || s
      WHEN 4 THEN ' ' || h || ':' || m || ':' || s || ' '
      WHEN 5 THEN '-' || h || ':+' || m || ':' || s
      WHEN 6 THEN h || ':' || m || ':' || s || ':' || s
      WHEN 7 THEN h || ':' || m || ':' || s END AS time_text
  FROM texts
)
SELECT l_orderkey, l_linenumber, time_text,
  CASE WHEN regexp_full_match(time_text, '{_HMS}') THEN
    CAST(regexp_extract(time_text, '{_HMS}', 1) AS BIGINT) * 3600
    + CAST(regexp_extract(time_text, '{_HMS}', 2) AS BIGINT) * 60
    + CAST(regexp_extract(time_text, '{_HMS}', 3) AS BIGINT) END AS seconds
FROM built""",
        "epoch_to_timestamp_column": """
WITH seconds AS (
  SELECT event_id, event_id % 7 AS kind, CAST(FLOOR(EPOCH_US(ts) / 1000000) AS BIGINT) AS s FROM events
)
SELECT event_id,
  CASE kind WHEN 0 THEN s || '.0' WHEN 1 THEN 'nan' WHEN 2 THEN '1e30' WHEN 3 THEN 'soon'
            WHEN 4 THEN s || '.75' WHEN 5 THEN CAST(s AS VARCHAR) END AS epoch_text,
  CASE WHEN kind IN (0, 4, 5) THEN make_timestamp(s * 1000000) END AS event_dt
FROM seconds""",
        "trip_first_stop": f"""
WITH {_SEEN} SELECT trip_id, MIN(stop_sequence) AS first_seq FROM feed GROUP BY trip_id""",
        "trip_relative_delay": f"WITH {_RELATIVE} SELECT {_EVENT} FROM events_sec",
        "service_day_delay": f"WITH {_SERVICE_DAY} SELECT {_EVENT} FROM events_sec",
        "delay_interval_top10": f"""
WITH {_SERVICE_DAY}
SELECT trip_id, stop_sequence, stop_id, make_timestamp(arr * 1000000) AS arrival_dt_utc,
  CAST(local_day AS VARCHAR) AS local_service_day, sec AS arrival_time_sec,
  make_timestamp(plan * 1000000) AS scheduled_ts_utc, late AS delay_duration
FROM events_sec WHERE {_ON_DAY}
ORDER BY late DESC, trip_id, stop_sequence, stop_id LIMIT 10""",
        "avg_delay_by_minute": f"""
WITH {_RELATIVE} SELECT {_MINUTE} AS minute_ts, {_AVG} FROM events_sec GROUP BY 1""",
        "avg_delay_by_minute_service_day": f"""
WITH {_SERVICE_DAY} SELECT {_MINUTE} AS minute_ts, {_AVG} FROM events_sec GROUP BY 1""",
        "vehicle_positions_with_delay": f"WITH {_RELATIVE}, {_VEHICLES} {_POSITIONS}",
        "vehicle_positions_service_day_delay": f"WITH {_SERVICE_DAY}, {_VEHICLES} {_POSITIONS}",
        "avg_delay_by_stop": f"""
WITH {_RELATIVE}, {_STOPS} {_STOP_AVERAGE.format(events="events_sec")}""",
        "avg_delay_by_stop_today": f"""
WITH {_SERVICE_DAY}, {_STOPS}, today AS (SELECT * FROM events_sec WHERE {_ON_DAY})
{_STOP_AVERAGE.format(events="today")}""",
        "avg_delay_by_route": f"""
WITH {_RELATIVE}, {_TRIPS}
SELECT t.route_id, {_AVG} FROM events_sec e JOIN trips t ON t.trip_id = e.trip_id GROUP BY 1""",
        "route_delay_with_counts": f"""
WITH {_RELATIVE}, {_TRIPS}
SELECT t.route_id, {_AVG}, COUNT(*) AS num_events
FROM events_sec e LEFT JOIN trips t ON t.trip_id = e.trip_id GROUP BY 1""",
        "vehicle_route_delay_top20": f"""
WITH {_RELATIVE}, {_VEHICLES}
SELECT v.route_id, {_AVG}, COUNT(*) AS num_events
FROM vehicles v LEFT JOIN events_sec e ON e.trip_id = v.trip_id
WHERE v.at_sec IS NOT NULL
GROUP BY v.route_id ORDER BY avg_delay_min DESC NULLS LAST, v.route_id LIMIT 20""",
        "punctuality_rate": f"""
WITH {_RELATIVE}
SELECT COUNT(*) AS total_events, CAST(COALESCE(SUM(CASE WHEN late <= 300 THEN 1 ELSE 0 END), 0) AS BIGINT)
    AS on_time_events,
  ROUND(100.0 * SUM(CASE WHEN late <= 300 THEN 1 ELSE 0 END)::DOUBLE / COUNT(*)::DOUBLE, 2) AS pct_on_time
FROM events_sec""",
        "delay_summary": f"""
WITH {_RELATIVE}
SELECT MIN(late) / 60.0 AS min_delay, MAX(late) / 60.0 AS max_delay, {_MEAN} AS avg_delay
FROM events_sec""",
        "worst_events": f"""
WITH {_SERVICE_DAY}, ranked AS (
  SELECT * FROM events_sec WHERE {_ON_DAY}
  ORDER BY late DESC, trip_id, stop_sequence, stop_id LIMIT 50
)
SELECT stop_id, make_timestamp(arr * 1000000) AS arrival_dt_utc,
  make_timestamp(plan * 1000000) AS scheduled_ts_utc, late / 60.0 AS delay_min
FROM ranked""",
        "latest_events": f"""
WITH {_RELATIVE}, ranked AS (
  SELECT * FROM events_sec ORDER BY arr DESC NULLS LAST, trip_id, stop_sequence, stop_id LIMIT 100
) SELECT {_EVENT} FROM ranked""",
        "latest_vehicles": f"""
WITH {_VEHICLES}
SELECT trip_id, route_id, latitude, longitude, make_timestamp(at_sec * 1000000) AS ts_utc
FROM vehicles ORDER BY at_sec DESC NULLS LAST, trip_id, route_id, latitude, longitude LIMIT 5""",
        "latest_vehicle_delays": f"""
WITH {_SERVICE_DAY}, {_VEHICLES}
SELECT v.trip_id, v.route_id, v.latitude, v.longitude, make_timestamp(v.at_sec * 1000000) AS ts_utc,
  e.late / 60.0 AS delay_min
FROM vehicles v LEFT JOIN events_sec e ON e.trip_id = v.trip_id
ORDER BY v.at_sec DESC NULLS LAST, v.trip_id, v.route_id, v.latitude, v.longitude,
  delay_min NULLS LAST LIMIT 10""",
        "worst_stops": f"""
WITH {_RELATIVE}, {_STOPS} {_STOP_AVERAGE.format(events="events_sec")}
ORDER BY avg_delay_min DESC NULLS LAST, p.stop_id LIMIT 700""",
        "worst_stops_today": f"""
WITH {_SERVICE_DAY}, {_STOPS}, today AS (SELECT * FROM events_sec WHERE {_ON_DAY})
{_STOP_AVERAGE.format(events="today")}
ORDER BY avg_delay_min DESC NULLS LAST, p.stop_id LIMIT 10""",
        "trips_plus_routes": f"""
WITH {_TRIPS}, {_ROUTES}
SELECT t.*, r.route_short_name, r.route_long_name
FROM trips t LEFT JOIN routes r ON r.route_id IS NOT DISTINCT FROM t.route_id""",
        "trips_merged_on_route": f"""
WITH {_TRIPS}, {_ROUTES}
SELECT t.* FROM trips t LEFT JOIN routes r ON r.route_id IS NOT DISTINCT FROM t.route_id""",
        "table_row_count": f"WITH {_SEEN} SELECT COUNT(*) AS n_rows FROM feed",
        "stops_with_geometry": f"""
WITH {_STOPS}
SELECT *, 'POINT (' || regexp_replace(CAST(stop_lon AS VARCHAR), '\\.0$', '') || ' '
  || regexp_replace(CAST(stop_lat AS VARCHAR), '\\.0$', '') || ')' AS geometry
FROM places""",
        "null_profile": f"""
WITH {_SEEN}, counted AS (
  SELECT COUNT(*) AS n, COUNT(trip_id) AS trip_id, COUNT(route_id) AS route_id,
    COUNT(direction_id) AS direction_id, COUNT(stop_id) AS stop_id,
    COUNT(stop_sequence) AS stop_sequence, COUNT(arrival_time) AS arrival_time,
    COUNT(departure_time) AS departure_time
  FROM feed
)
SELECT 'trip_id' AS "column", n - trip_id AS nulls FROM counted
UNION ALL SELECT 'route_id', n - route_id FROM counted
UNION ALL SELECT 'direction_id', n - direction_id FROM counted
UNION ALL SELECT 'stop_id', n - stop_id FROM counted
UNION ALL SELECT 'stop_sequence', n - stop_sequence FROM counted
UNION ALL SELECT 'arrival_time', n - arrival_time FROM counted
UNION ALL SELECT 'departure_time', n - departure_time FROM counted
UNION ALL SELECT 'arrival_dt', n - arrival_time FROM counted
UNION ALL SELECT 'departure_dt', n - departure_time FROM counted""",
        "static_tables_load": _timetable(
            "CAST(trip_id AS VARCHAR) AS trip_id, arrival_time, departure_time,"
            " CAST(stop_id AS VARCHAR) AS stop_id, stop_sequence, sec AS arrival_time_sec,"
            " sec + 30 AS departure_time_sec"
        ),
        "typed_tables_load": f"""
WITH {_STOPS} SELECT CAST(stop_id AS VARCHAR) AS stop_id, stop_name, stop_lat, stop_lon FROM places""",
        "flat_feed_load": f"""
WITH {_SEEN}
SELECT CAST(trip_id AS VARCHAR) AS trip_id, CAST(route_id AS VARCHAR) AS route_id, direction_id,
  CAST(stop_id AS VARCHAR) AS stop_id, stop_sequence, arrival_time, departure_time,
  make_timestamp(arrival_time * 1000000) AS arrival_dt,
  make_timestamp(departure_time * 1000000) AS departure_dt
FROM feed""",
        "flat_vehicle_load": f"""
WITH {_VEHICLES}
SELECT CAST(trip_id AS VARCHAR) AS trip_id, route_id, CAST(NULL AS VARCHAR) AS stop_id, latitude,
  longitude, CAST(NULL AS DOUBLE) AS bearing, CAST(NULL AS DOUBLE) AS speed, at_sec AS "timestamp",
  CAST(event_id AS VARCHAR) AS vehicle_id, make_timestamp(at_sec * 1000000) AS timestamp_dt
FROM vehicles""",
        "expand_archives": _timetable(
            "CAST(trip_id AS VARCHAR) AS trip_id, arrival_time, departure_time,"
            " CAST(stop_id AS VARCHAR) AS stop_id, stop_sequence, sec AS arrival_time_sec,"
            " sec + 30 AS departure_time_sec"
        ),
        "flatten_trip_updates": f"""
WITH {_SEEN}
SELECT CAST(trip_id AS VARCHAR) AS trip_id, CAST(route_id AS VARCHAR) AS route_id, direction_id,
  CAST(stop_id AS VARCHAR) AS stop_id, stop_sequence, arrival_time, departure_time
FROM feed
UNION ALL
SELECT CAST(trip_id AS VARCHAR), CAST(route_id AS VARCHAR), direction_id, NULL, 0, NULL, NULL FROM feed""",
        "flatten_vehicle_positions": f"""
WITH {_VEHICLES}
SELECT CAST(trip_id AS VARCHAR) AS trip_id, NULLIF(route_id, 'signup-3') AS route_id,
  CAST(NULL AS VARCHAR) AS stop_id, CAST(CAST(latitude AS FLOAT) AS DOUBLE) AS latitude,
  CAST(CAST(longitude AS FLOAT) AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS bearing,
  CAST(0.5 AS DOUBLE) AS speed, at_sec AS "timestamp", CAST(event_id AS VARCHAR) AS vehicle_id,
  make_timestamp(at_sec * 1000000) AS timestamp_dt
FROM vehicles""",
        "delay_heatmap": f"""
WITH {_RUN_MINUTES}
{_HEATMAP.format(rows=_BEFORE_AS_OF)}""",
        "delay_heatmap_selected_runs": f"""
WITH {_RUN_MINUTES}
{_HEATMAP.format(rows=_SELECTED)}""",
        "delay_heatmap_weighted": f"""
WITH {_RUN_EVENTS}, minutes AS (
  SELECT stamp, {_MINUTE} AS minute_ts, {_AVG}, SUM(late) AS late, COUNT(late) AS n
  FROM run_events GROUP BY 1, 2
), weighed AS (
  SELECT minute_ts,
    CASE WHEN stamp = '{STAMPS[0]}' THEN CAST(CAST(avg_delay_min AS VARCHAR) AS DECIMAL(38, 18)) * 60
         ELSE CAST(late AS DECIMAL(38, 18)) END AS late,
    CASE WHEN stamp = '{STAMPS[0]}' THEN CAST(avg_delay_min IS NOT NULL AS BIGINT) ELSE n END AS n
  FROM minutes WHERE minute_ts IS NOT NULL AND {_BEFORE_AS_OF}
)
SELECT strftime(minute_ts, '%Y-%m-%d') AS jour_date, strftime(minute_ts, '%H') AS heure,
  ROUND(CAST(SUM(late) AS DOUBLE) / NULLIF(SUM(n), 0) / 60.0, 2) AS avg_delay_min,
  CAST(SUM(n) AS BIGINT) AS nb_events
FROM weighed GROUP BY 1, 2""",
        "table_columns": """
SELECT * FROM (VALUES ('trip_id', 'bigint'), ('route_id', 'bigint'), ('direction_id', 'int'),
  ('stop_id', 'bigint'), ('stop_sequence', 'int'), ('arrival_time', 'bigint'),
  ('departure_time', 'bigint'), ('arrival_dt', 'timestamp'), ('departure_dt', 'timestamp')
) t("column", "type")""",
        "typed_routes_load": f"""
WITH {_ROUTES.strip()}
SELECT CAST(route_id AS VARCHAR) AS route_id, route_short_name, route_long_name FROM routes""",
        "typed_trips_load": f"""
WITH {_TRIPS.strip()}
SELECT CAST(trip_id AS VARCHAR) AS trip_id, CAST(route_id AS VARCHAR) AS route_id FROM trips""",
        "snapshot_union": f"""
WITH {_RUN_MINUTES}
SELECT minute_ts, avg_delay_min, strptime(stamp, '%Y%m%d_%H%M%S') AS snapshot_ts_temps
FROM minutes WHERE {_SELECTED}""",
        "stop_delay_evolution": f"""
WITH {_RUN_STOPS} SELECT * FROM stop_runs WHERE stop_id IN {WATCHED}""",
        "stop_delay_evolution_all": f"WITH {_RUN_STOPS} SELECT * FROM stop_runs",
        "stop_delay_evolution_dates": f"""
WITH {_RUN_STOPS} SELECT * FROM stop_runs WHERE {_IN_RANGE}""",
        "stop_delay_range": f"""
WITH {_RUN_STOPS}
SELECT stop_id, stop_name, MIN(avg_delay_min) AS min_delay, MAX(avg_delay_min) AS max_delay
FROM stop_runs WHERE avg_delay_min IS NOT NULL GROUP BY stop_id, stop_name""",
        "stop_delay_range_dates": f"""
WITH {_RUN_STOPS}
SELECT stop_id, stop_name, MIN(avg_delay_min) AS min_delay, MAX(avg_delay_min) AS max_delay
FROM stop_runs WHERE avg_delay_min IS NOT NULL AND {_IN_RANGE} GROUP BY stop_id, stop_name""",
        "daily_run": f"""
WITH {_RELATIVE}, {_VEHICLES}, {_STOPS}, {_TRIPS}, {_ROUTES},
minutes AS (SELECT {_MINUTE} AS minute_ts, {_AVG} FROM events_sec GROUP BY 1),
by_stop AS ({_STOP_AVERAGE.format(events="events_sec")})
SELECT 'avg_delay_by_minute' AS question,
  strftime(minute_ts, '%Y-%m-%d %H:%M:%S') AS item, avg_delay_min AS value FROM minutes
UNION ALL SELECT 'avg_delay_by_stop', CAST(stop_id AS VARCHAR), avg_delay_min FROM by_stop
UNION ALL SELECT 'position_bus_vehicles', concat_ws('|', trip_id,
  NULLIF(route_id, 'signup-3'), strftime(timestamp_paris, '%Y-%m-%d %H:%M:%S')), delay_min FROM ({_POSITIONS})
UNION ALL SELECT 'avg_delay_by_route', CAST(t.route_id AS VARCHAR), {_AVG}
  FROM events_sec e JOIN trips t ON t.trip_id = e.trip_id GROUP BY t.route_id
UNION ALL SELECT 'punctuality_rate', CAST(COUNT(*) AS VARCHAR),
  ROUND(100.0 * SUM(CASE WHEN late <= 300 THEN 1 ELSE 0 END)::DOUBLE / COUNT(*)::DOUBLE, 2)
  FROM events_sec
UNION ALL SELECT 'avg_delay_heatmap_Q5', concat_ws('|', jour_date, heure, nb_events), avg_delay_min
  FROM ({_HEATMAP.format(rows=_BEFORE_AS_OF)})
UNION ALL SELECT 'evolution_delay_by_stop_Q7', concat_ws('|', CAST(stop_id AS VARCHAR),
  '{_LABEL_TIME}'), avg_delay_min FROM by_stop WHERE CAST(stop_id AS VARCHAR) IN {WATCHED}
UNION ALL SELECT 'trips_plus_routes', concat_ws('|', t.trip_id, t.route_id, r.route_short_name,
  r.route_long_name), NULL
  FROM trips t LEFT JOIN routes r ON r.route_id IS NOT DISTINCT FROM t.route_id
UNION ALL SELECT 'stops_with_geom', CAST(stop_id AS VARCHAR), stop_lat FROM places""",
        "stream_avg_delay_by_minute": f"""
WITH {_RELATIVE} SELECT {_MINUTE} AS minute_ts, {_AVG} FROM events_sec GROUP BY 1""",
        "stream_stop_snapshots": f"WITH {_RUN_STOPS} SELECT * FROM stop_runs",
    }
