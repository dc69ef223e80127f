"""Independent SQL answers (DuckDB dialect) for the registered queries.

Written directly from the rules, without the Spark operators' tricks
(chunking, halos, grids, pointer doubling): plain windows over whole keys,
brute-force self joins, a recursive CTE for the cooldown chain.
"""

from __future__ import annotations

from . import catalog as C
from . import mapping as M


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_TB15 = "time_bucket(INTERVAL '15 minutes', \"timestamp\")"
_TB10 = "time_bucket(INTERVAL '10 minutes', \"timestamp\")"

WARD_ENERGY = _with(M.SMART_METERS_SQL) + f"""
SELECT ward_id, {_TB15} AS window_start, {_TB15} + INTERVAL '15 minutes' AS window_end,
       CAST(SUM(CAST(kwh_reading AS DECIMAL(18,2))) AS DOUBLE) AS total_kwh_consumed,
       CAST(SUM(CAST(power_factor AS DECIMAL(18,3))) AS DOUBLE) / COUNT(power_factor) AS avg_power_factor,
       MAX(voltage) AS peak_voltage, CAST({_TB15} AS DATE) AS date
FROM smart_meters GROUP BY ward_id, {_TB15}"""

ZONE_AVG = _with(M.AIR_QUALITY_SQL) + f"""
SELECT zone, {_TB10} AS window_start, {_TB10} + INTERVAL '10 minutes' AS window_end,
       CAST(SUM(aqi) AS DOUBLE) / COUNT(aqi) AS rolling_avg_aqi, COUNT(*) AS sensor_readings
FROM air_quality WHERE aqi IS NOT NULL GROUP BY zone, {_TB10}"""

ROLLING_SLIDE = _with(M.AIR_QUALITY_SQL, """w AS (
  SELECT zone, aqi, time_bucket(INTERVAL '5 minutes', "timestamp") - INTERVAL (o * 5) MINUTE AS window_start
  FROM air_quality, (VALUES (0), (1)) AS offs(o) WHERE aqi IS NOT NULL)""") + """
SELECT zone, window_start, window_start + INTERVAL '10 minutes' AS window_end,
       CAST(SUM(aqi) AS DOUBLE) / COUNT(aqi) AS rolling_avg_aqi, COUNT(*) AS sensor_readings
FROM w GROUP BY zone, window_start"""

ZONE_ADVISORY = _with(M.AIR_QUALITY_SQL, M.zone_profile_sql(), f"""a AS (
  SELECT zone, {_TB10} AS window_start, {_TB10} + INTERVAL '10 minutes' AS window_end,
         CAST(SUM(aqi) AS DOUBLE) / COUNT(aqi) AS rolling_avg_aqi, COUNT(*) AS sensor_readings
  FROM air_quality WHERE aqi IS NOT NULL GROUP BY zone, {_TB10})""") + f"""
SELECT a.zone, COALESCE(p.zone_name, a.zone) AS zone_name, window_start, window_end, rolling_avg_aqi,
       p.population, p.num_schools, p.num_hospitals, sensor_readings,
       CASE WHEN rolling_avg_aqi > 300 THEN 'HAZARDOUS' ELSE 'UNHEALTHY' END AS advisory_level,
       'Air quality in ' || COALESCE(p.zone_name, a.zone) || ' is '
         || CASE WHEN rolling_avg_aqi > 300 THEN 'HAZARDOUS' ELSE 'UNHEALTHY' END
         || '. Rolling 10-min AQI = ' || printf('%.0f', rolling_avg_aqi) || '. '
         || COALESCE(CAST(p.num_schools AS VARCHAR), '?') || ' schools and '
         || COALESCE(CAST(p.num_hospitals AS VARCHAR), '?') || ' hospitals affected. Population at risk: '
         || printf('%,d', COALESCE(p.population, 0)) || '.' AS advisory_text
FROM a LEFT JOIN zone_profile p ON a.zone = p.zone
WHERE rolling_avg_aqi > {C.ADVISORY_ABOVE}"""

DOWNSAMPLE = _with(M.AIR_QUALITY_SQL) + """
SELECT sensor_id, time_bucket(INTERVAL '6 hours', "timestamp") AS window_start,
       time_bucket(INTERVAL '6 hours', "timestamp") + INTERVAL '6 hours' AS window_end,
       CAST(SUM(CAST(pm25 AS DECIMAL(18,2))) AS DOUBLE) / COUNT(pm25) AS avg_value,
       MIN(pm25) AS min_value, MAX(pm25) AS max_value, COUNT(pm25) AS n
FROM air_quality GROUP BY 1, 2"""

LATEST = _with(M.AIR_QUALITY_SQL) + """
SELECT sensor_id, "timestamp", zone, aqi, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY "timestamp" DESC, event_id DESC) AS rn
  FROM air_quality) WHERE rn = 1"""

RETENTION = f"""
SELECT event_id, user_id, event_type, ts FROM events
WHERE ts >= TIMESTAMP '{C.RETENTION_AS_OF}' - INTERVAL 7 DAY"""

WEEKLY = f"""WITH w AS ({WARD_ENERGY})
SELECT date_trunc('week', window_start) AS week_start, ward_id,
       CAST(SUM(CAST(total_kwh_consumed AS DECIMAL(18,2))) AS DOUBLE) AS total_kwh,
       MAX(peak_voltage) AS peak_voltage, COUNT(*) AS windows
FROM w GROUP BY 1, 2"""

MONTHLY = _with(M.AIR_QUALITY_SQL, """m AS (
  SELECT zone, date_trunc('month', "timestamp") AS month,
         CAST(SUM(aqi) AS DOUBLE) / COUNT(aqi) AS avg_aqi, MAX(aqi) AS max_aqi, COUNT(*) AS readings
  FROM air_quality WHERE aqi IS NOT NULL GROUP BY 1, 2)""") + """
SELECT *, avg_aqi - lag(avg_aqi) OVER (PARTITION BY zone ORDER BY month) AS change FROM m"""

_TBH = "time_bucket(INTERVAL '1 hour', \"timestamp\")"
REMAP = _with(M.SMART_METERS_SQL, """moved AS (
  SELECT s.*, COALESCE('WARD-' || lpad(CAST(c.c_nationkey AS VARCHAR), 3, '0'), 'UNKNOWN') AS new_ward
  FROM smart_meters s LEFT JOIN customer c ON s.user_id = c.c_custkey)""") + f"""
SELECT new_ward AS ward_id, {_TBH} AS window_start, {_TBH} + INTERVAL '1 hour' AS window_end,
       CAST(SUM(CAST(kwh_reading AS DECIMAL(18,2))) AS DOUBLE) AS total_kwh_consumed,
       CAST(SUM(CAST(power_factor AS DECIMAL(18,3))) AS DOUBLE) / COUNT(power_factor) AS avg_power_factor,
       MAX(voltage) AS peak_voltage, CAST({_TBH} AS DATE) AS date
FROM moved GROUP BY new_ward, {_TBH}"""

ENRICH_LOOKUP = _with(M.CUSTOMER_DIM_SQL) + """
SELECT o.o_custkey, o.o_orderkey, o.o_totalprice, o.o_orderdate, c.c_name, c.c_nationkey, c.c_mktsegment
FROM orders o JOIN cdim c ON o.o_custkey = c.o_custkey"""

ENRICH_UNMATCHED = _with(M.CUSTOMER_DIM_SQL) + """
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM cdim c WHERE c.o_custkey = o.o_custkey)"""

ENRICH_LEFT = _with(M.CUSTOMER_DIM_SQL) + """
SELECT o.o_custkey, o.o_orderkey, COALESCE(c.c_name, 'UNKNOWN') AS c_name, c.c_nationkey,
       COALESCE(c.c_mktsegment, 'N/A') AS c_mktsegment
FROM orders o LEFT JOIN cdim c ON o.o_custkey = c.o_custkey"""

ENRICH_COUNTS = _with(M.CUSTOMER_DIM_SQL) + """
SELECT COUNT(*) FILTER (WHERE EXISTS (SELECT 1 FROM cdim c WHERE c.o_custkey = o.o_custkey)) AS joined,
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM cdim c WHERE c.o_custkey = o.o_custkey)) AS unmatched
FROM orders o"""

JSON_DECODE = """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""

_CHECKED = _with(M.RAW_FIELDS_SQL, M.ERRORS_SQL)

DLQ_ERRORS = _CHECKED + """
SELECT event_id, topic, error, error_pos FROM (
  SELECT event_id, topic, unnest(errors) AS error, CAST(unnest(range(1, len(errors) + 1)) AS INTEGER) AS error_pos
  FROM checked WHERE len(errors) > 0)"""

DLQ_SPLIT = _CHECKED + """
SELECT event_id, topic, len(errors) = 0 AS is_valid, CAST(len(errors) AS INTEGER) AS n_errors,
       errors[1] AS error_reason FROM checked"""

DLQ_SUMMARY = _CHECKED + """
SELECT topic, COUNT(*) AS total, COUNT(*) FILTER (WHERE len(errors) = 0) AS valid,
       COUNT(*) FILTER (WHERE len(errors) > 0) AS dlq,
       round(COUNT(*) FILTER (WHERE len(errors) > 0) * 100.0 / COUNT(*), 1) AS dlq_rate_pct
FROM checked GROUP BY topic"""

DLQ_REPORT_TOTALS = _CHECKED + """,
per AS (
  SELECT topic, CASE WHEN len(errors) = 0 THEN 1 ELSE 0 END AS valid, CASE WHEN len(errors) > 0 THEN 1 ELSE 0 END AS dlq FROM checked
  UNION ALL SELECT unnest(['air_quality', 'bus_gps', 'traffic_signals', 'smart_meters', 'parking']), 0, 0),
both_rows AS (SELECT * FROM per UNION ALL SELECT 'TOTAL', valid, dlq FROM per)
SELECT topic, CAST(SUM(valid) AS BIGINT) AS valid, CAST(SUM(dlq) AS BIGINT) AS dlq,
       CASE WHEN SUM(valid) + SUM(dlq) > 0 THEN round(SUM(dlq) * 100.0 / (SUM(valid) + SUM(dlq)), 1) END AS dlq_rate_pct
FROM both_rows GROUP BY topic"""

_TB5 = "time_bucket(INTERVAL '5 minutes', \"timestamp\")"

DLQ_REPORT_5M = _CHECKED + f""",
per AS (
  SELECT {_TB5} AS window_start, topic, CASE WHEN len(errors) = 0 THEN 1 ELSE 0 END AS valid, CASE WHEN len(errors) > 0 THEN 1 ELSE 0 END AS dlq FROM checked),
rows_ AS (
  SELECT * FROM per
  UNION ALL SELECT window_start, 'TOTAL', valid, dlq FROM per
  UNION ALL SELECT DISTINCT window_start, unnest(['air_quality', 'bus_gps', 'traffic_signals', 'smart_meters', 'parking']), 0, 0 FROM per)
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, topic, CAST(SUM(valid) + SUM(dlq) AS BIGINT) AS total,
       CAST(SUM(valid) AS BIGINT) AS valid, CAST(SUM(dlq) AS BIGINT) AS dlq,
       CASE WHEN SUM(valid) + SUM(dlq) > 0 THEN round(SUM(dlq) * 100.0 / (SUM(valid) + SUM(dlq)), 1) END AS dlq_rate_pct
FROM rows_ GROUP BY window_start, topic"""

DLQ_ERRORS_5M = _CHECKED + f"""
SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, topic, split_part(error, ':', 1) AS error, COUNT(*) AS count
FROM (SELECT {_TB5} AS window_start, topic, unnest(errors) AS error FROM checked) GROUP BY 1, 2, 3, 4"""

FRACTIONAL_READINGS = """
WITH r AS (SELECT event_id, event_id % 2 = 0 AS aq, value * 8 AS aqi, value - 20 AS wait FROM events)
SELECT event_id, CASE WHEN aq THEN aqi BETWEEN 0 AND 500 ELSE wait >= 0 END AS is_valid,
       CASE WHEN aq AND NOT aqi BETWEEN 0 AND 500
              THEN 'aqi_out_of_range:' || CASE WHEN aqi = floor(aqi) THEN CAST(CAST(aqi AS BIGINT) AS VARCHAR) ELSE CAST(aqi AS VARCHAR) END
            WHEN NOT aq AND wait < 0 THEN 'negative_wait_sec' END AS error_reason
FROM r"""

ENRICH_LAST_ROW_WINS = """
SELECT c_custkey, c_name, max(o_orderkey) AS o_orderkey, arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1, 2"""

DLQ_DIST = _CHECKED + """
SELECT topic, error, COUNT(*) AS count FROM (SELECT topic, unnest(errors) AS error FROM checked)
GROUP BY topic, error"""

DLQ_TYPES = _CHECKED + """
SELECT topic, split_part(error, ':', 1) AS error, COUNT(*) AS count
FROM (SELECT topic, unnest(errors) AS error FROM checked) GROUP BY 1, 2"""

DLQ_TOP = _CHECKED + """
SELECT topic, error, COUNT(*) AS count FROM (SELECT topic, unnest(errors) AS error FROM checked)
GROUP BY topic, error ORDER BY count DESC, topic, error LIMIT 10"""

DLQ_ENVELOPE = _CHECKED + """
SELECT topic AS key, topic AS original_topic, errors[1] AS error_reason,
       CAST(len(errors) AS INTEGER) AS n_errors, array_to_string(errors, '|') AS all_errors,
       payload AS original_data
FROM checked WHERE len(errors) > 0"""

DLQ_REPLAY = _CHECKED + """
SELECT topic AS original_topic, split_part(errors[1], ':', 1) AS first_error,
       0::BIGINT AS recovered, COUNT(*) AS still_invalid
FROM checked WHERE len(errors) > 0 GROUP BY 1, 2"""

# The cooldown chain, followed one alert at a time by a recursive CTE.
ALERTS_COOLDOWN = "WITH RECURSIVE " + ",\n".join([M.AIR_QUALITY_SQL, f"""b AS (
  SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY "timestamp", event_id) AS rn
  FROM air_quality WHERE aqi > {C.AQI_ALERT_ABOVE})""", """nx AS (
  SELECT b1.sensor_id, b1.rn, MIN(b2.rn) AS next_rn FROM b b1 JOIN b b2
    ON b1.sensor_id = b2.sensor_id AND b2."timestamp" >= b1."timestamp" + INTERVAL '2 days'
  GROUP BY 1, 2)""", """chain AS (
  SELECT sensor_id, rn FROM b WHERE rn = 1
  UNION ALL
  SELECT nx.sensor_id, nx.next_rn FROM chain JOIN nx ON chain.sensor_id = nx.sensor_id AND chain.rn = nx.rn)"""]) \
    + f"""
SELECT 'AQI_EMERGENCY' AS incident_type, b.sensor_id, b.zone, b.aqi, b.pm25, {C.AQI_ALERT_ABOVE} AS threshold,
       'HAZARDOUS AQI ' || CAST(b.aqi AS VARCHAR) || ' at sensor ' || b.sensor_id || ' zone ' || b.zone AS message,
       b."timestamp" AS event_time, b.event_id
FROM chain JOIN b ON chain.sensor_id = b.sensor_id AND chain.rn = b.rn"""

ALERTS_CONSECUTIVE = _with(M.TRAFFIC_SQL, """w AS (
  SELECT *, lag("timestamp", 2) OVER k AS t2,
         MIN(avg_wait_sec) OVER (k ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS mn,
         AVG(CAST(avg_wait_sec AS DOUBLE)) OVER (k ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS av
  FROM traffic WINDOW k AS (PARTITION BY junction_id ORDER BY "timestamp", event_id))""") + f"""
SELECT 'TRAFFIC_GRIDLOCK' AS incident_type, junction_id, zone, round(av, 1) AS avg_wait_sec,
       3 AS consecutive_readings,
       'GRIDLOCK at ' || junction_id || ' zone ' || zone || ' — avg wait ' || printf('%.0f', av)
         || 's for 3 cycles' AS message,
       "timestamp" AS event_time, event_id
FROM w WHERE t2 IS NOT NULL AND t2 >= "timestamp" - INTERVAL 3 DAY AND mn > {C.WAIT_ABOVE}"""

_HAV = """6371000.0 * 2 * atan2(sqrt(
    pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2)),
  sqrt(1 - (pow(sin(radians(q.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(q.lat)) * pow(sin(radians(q.lon - p.lon) / 2), 2))))"""

_PAIRS_CTE = f"""seen AS (
  SELECT *, lead("timestamp") OVER s AS next_ts, lead(event_id) OVER s AS next_id
  FROM bus_gps WINDOW s AS (PARTITION BY route_id, bus_id ORDER BY "timestamp", event_id)),
near AS (
  SELECT p.*, q.event_id AS l_event_id, q.bus_id AS l_bus_id, q."timestamp" AS l_ts, {_HAV} AS distance_m
  FROM seen p JOIN seen q ON p.route_id = q.route_id AND p.bus_id <> q.bus_id
   AND (p."timestamp" < q."timestamp" OR (p."timestamp" = q."timestamp" AND p.event_id < q.event_id))
   AND epoch_us(q."timestamp") - epoch_us(p."timestamp") <= 1800000000
   AND (p.next_ts IS NULL OR q."timestamp" < p.next_ts OR (q."timestamp" = p.next_ts AND q.event_id < p.next_id))),
pairs AS (
  SELECT route_id, least(bus_id, l_bus_id) AS bus_id_1, greatest(bus_id, l_bus_id) AS bus_id_2,
         CASE WHEN bus_id < l_bus_id THEN event_id ELSE l_event_id END AS event_id_1,
         CASE WHEN bus_id < l_bus_id THEN l_event_id ELSE event_id END AS event_id_2,
         CASE WHEN bus_id < l_bus_id THEN "timestamp" ELSE l_ts END AS ts_1,
         CASE WHEN bus_id < l_bus_id THEN l_ts ELSE "timestamp" END AS ts_2,
         l_ts AS pair_time, distance_m, (epoch_us(l_ts) - epoch_us("timestamp")) / 1000000.0 AS gap_sec
  FROM near)"""

PROXIMITY_PAIRS = _with(M.BUS_GPS_SQL, _PAIRS_CTE) + f"""
SELECT route_id, bus_id_1, bus_id_2, event_id_1, event_id_2, ts_1, ts_2, pair_time,
       round(distance_m, 3) AS distance_m, gap_sec
FROM pairs WHERE distance_m <= {C.BUNCH_DISTANCE_M}"""

PROXIMITY_INCIDENTS = _with(M.BUS_GPS_SQL, _PAIRS_CTE, f"""cp AS (
  SELECT *, CASE WHEN lag(pair_time) OVER k IS NULL
                   OR epoch_us(pair_time) - epoch_us(lag(pair_time) OVER k) > 7200000000 THEN 1 ELSE 0 END AS st
  FROM pairs WHERE distance_m <= {C.BUNCH_DISTANCE_M}
  WINDOW k AS (PARTITION BY route_id, bus_id_1, bus_id_2 ORDER BY pair_time))""", """isl AS (
  SELECT *, SUM(st) OVER (PARTITION BY route_id, bus_id_1, bus_id_2 ORDER BY pair_time
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM cp)""") + """
SELECT route_id, bus_id_1, bus_id_2, MIN(pair_time) AS start_time, MAX(pair_time) AS end_time,
       COUNT(*) AS sightings, round(MIN(distance_m), 3) AS min_distance_m,
       (epoch_us(MAX(pair_time)) - epoch_us(MIN(pair_time))) / 1000000.0 AS duration_sec
FROM isl GROUP BY route_id, bus_id_1, bus_id_2, island
HAVING epoch_us(MAX(pair_time)) - epoch_us(MIN(pair_time)) >= 3600000000"""

STREAM_BUNCHING_CLOCK = _with(M.BUS_GPS_SQL, _PAIRS_CTE, f"""m AS (
  SELECT route_id, bus_id_1, bus_id_2, pair_time, distance_m,
         CASE WHEN ts_1 = pair_time AND (ts_2 < pair_time OR event_id_1 > event_id_2) THEN event_id_1 ELSE event_id_2 END AS event_id,
         epoch_us(pair_time) AS t
  FROM pairs WHERE distance_m <= {C.BUNCH_DISTANCE_M})""", """r AS (
  SELECT *, row_number() OVER (PARTITION BY route_id, bus_id_1, bus_id_2 ORDER BY t, event_id) AS n FROM m)""", """jump AS (
  SELECT a.route_id, a.bus_id_1, a.bus_id_2, a.n, min(b.n) AS nxt
  FROM r a JOIN r b ON a.route_id = b.route_id AND a.bus_id_1 = b.bus_id_1 AND a.bus_id_2 = b.bus_id_2
   AND b.n > a.n AND b.t >= a.t + 3600000000
  GROUP BY 1, 2, 3, 4)""", """step AS (
  SELECT j.route_id, j.bus_id_1, j.bus_id_2, j.n, j.nxt, b.t - a.t <= 7200000000 AS alert, b.t - a.t AS ran
  FROM jump j JOIN r a USING (route_id, bus_id_1, bus_id_2, n)
  JOIN r b ON b.route_id = j.route_id AND b.bus_id_1 = j.bus_id_1 AND b.bus_id_2 = j.bus_id_2 AND b.n = j.nxt)""", """chain AS (
  SELECT route_id, bus_id_1, bus_id_2, 1::BIGINT AS n FROM r WHERE r.n = 1
  UNION ALL
  SELECT s.route_id, s.bus_id_1, s.bus_id_2, CASE WHEN s.alert THEN s.nxt + 1 ELSE s.nxt END
  FROM chain c JOIN step s USING (route_id, bus_id_1, bus_id_2, n))""").replace("WITH ", "WITH RECURSIVE ", 1) + """
SELECT r.route_id, r.bus_id_1 AS bus_1, r.bus_id_2 AS bus_2, round(r.distance_m, 3) AS distance_m,
       s.ran / 1000000.0 AS duration_sec, r.pair_time AS event_time, r.event_id
FROM chain c JOIN step s USING (route_id, bus_id_1, bus_id_2, n)
JOIN r ON r.route_id = s.route_id AND r.bus_id_1 = s.bus_id_1 AND r.bus_id_2 = s.bus_id_2 AND r.n = s.nxt
WHERE s.alert"""

DLQ_REPLAY_REPAIRED = _CHECKED + """
SELECT topic AS original_topic, len([x FOR x IN errors IF NOT starts_with(x, 'aqi_out_of_range')]) = 0 AS recovered, COUNT(*) AS messages
FROM checked WHERE len(errors) > 0 GROUP BY 1, 2"""

KEYED_JSON_ROUND_TRIP = "SELECT event_type AS key, event_type AS zone, event_id, value FROM events"

KEYED_EXPORT_ORDER = """
SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS position FROM events"""

ZONE_AVG_NULL_AQI = ZONE_AVG.replace("WHERE aqi IS NOT NULL", "WHERE aqi IS NOT NULL AND event_id % 10 <> 0")

PRESENTED_WARD_ENERGY = f"""
SELECT ward_id, window_start, window_end, CAST(round_even(CAST(total_kwh_consumed AS DECIMAL(28,12)), 3) AS DOUBLE) AS total_kwh_consumed,
       CAST(round_even(CAST(avg_power_factor AS DECIMAL(28,17)), 4) AS DOUBLE) AS avg_power_factor,
       CAST(round_even(CAST(peak_voltage AS DECIMAL(28,12)), 1) AS DOUBLE) AS peak_voltage, date
FROM ({WARD_ENERGY})"""

STREAM_WARD_ENERGY_FINAL = f"""
SELECT * FROM ({WARD_ENERGY})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 45 MINUTE"""

STREAM_ADVISORY_ARCHIVE = f"""
SELECT *, CAST(window_start AS DATE) AS date FROM ({ZONE_ADVISORY})
WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"""

LATE_EVENTS = f"""
WITH e AS (SELECT event_id, event_type, ts - to_hours(CAST(event_id % {C.LATE_SHIFT_HOURS} AS INTEGER)) AS event_time
           FROM events),
w AS (SELECT *, MAX(event_time) OVER (PARTITION BY event_type ORDER BY event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx FROM e)
SELECT event_id, event_type, event_time FROM w WHERE event_time < mx - INTERVAL 2 HOUR"""

INCIDENTS_UNION = f"""
WITH a AS ({ALERTS_COOLDOWN}),
g AS ({ALERTS_CONSECUTIVE}),
b AS ({PROXIMITY_INCIDENTS.replace("round(MIN(distance_m), 3) AS min_distance_m", "MIN(distance_m) AS min_distance_m")})
SELECT incident_type, sensor_id, NULL::VARCHAR AS junction_id, zone, NULL::VARCHAR AS route_id, NULL::VARCHAR AS bus_1, NULL::VARCHAR AS bus_2,
       CAST(aqi AS DOUBLE) AS aqi, pm25, CAST(threshold AS DOUBLE) AS threshold, NULL::DOUBLE AS avg_wait_sec, NULL::INTEGER AS consecutive_readings,
       NULL::DOUBLE AS distance_m, NULL::DOUBLE AS duration_sec, message, event_time FROM a
UNION ALL
SELECT incident_type, NULL, junction_id, zone, NULL, NULL, NULL, NULL, NULL, NULL, avg_wait_sec, consecutive_readings, NULL, NULL, message, event_time FROM g
UNION ALL
SELECT 'BUS_BUNCHING', NULL, NULL, NULL, route_id, bus_id_1, bus_id_2, NULL, NULL, NULL, NULL, NULL,
       round(min_distance_m, 1), CAST(printf('%.0f', duration_sec) AS DOUBLE),
       'BUNCHING on route ' || route_id || ': buses ' || bus_id_1 || ' & ' || bus_id_2 || ' within '
         || printf('%.0f', min_distance_m) || 'm for ' || printf('%.1f', duration_sec / 60) || ' min',
       end_time FROM b"""

INCIDENT_COUNTS = f"""SELECT incident_type, COUNT(*) AS alerts FROM ({INCIDENTS_UNION}) GROUP BY 1"""

DOMAIN_SCALARS = _with(M.BUS_GPS_SQL, M.AIR_QUALITY_SQL) + """
SELECT b.event_id, a.aqi,
       strftime(time_bucket(INTERVAL '15 minutes', b."timestamp"), '%Y-%m-%dT%H:%M') AS bucket_15m,
       CAST(b."timestamp" AS DATE) AS event_date, b."timestamp" AS parsed_ts,
       round(6371000.0 * 2 * atan2(sqrt(pow(sin(radians(b.lat - 12.9716) / 2), 2)
             + cos(radians(12.9716)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - 77.5946) / 2), 2)),
             sqrt(1 - (pow(sin(radians(b.lat - 12.9716) / 2), 2)
             + cos(radians(12.9716)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - 77.5946) / 2), 2)))), 3)
         AS dist_center_m,
       CAST(round_even(CAST(b.lat AS DECIMAL(12,4)), 2) AS DOUBLE) AS lat_2dp_even,
       epoch_us(b."timestamp") / 1000000.0 AS epoch_s
FROM bus_gps b JOIN air_quality a ON a.event_id = b.event_id"""

AQI_HISTORY = _with(M.AIR_QUALITY_SQL) + """
SELECT sensor_id, zone, pm25, aqi, "timestamp", event_id, CAST("timestamp" AS DATE) AS date FROM air_quality"""

WARD_ENERGY_TWO_SINKS = f"""
SELECT 'records' AS sink, * FROM ({WARD_ENERGY}) UNION ALL SELECT 'versions', * FROM ({WARD_ENERGY})"""

STREAM_ADVISORY_ARCHIVE_ALL = f"""SELECT *, CAST(window_start AS DATE) AS date FROM ({ZONE_ADVISORY})"""

WARD_ENERGY_LIVE = f"""
SELECT 'json' AS sink, * FROM ({WARD_ENERGY}) UNION ALL SELECT 'parquet', * FROM ({WARD_ENERGY})"""

_ROUTED = M.BUS_GPS_SQL.replace("event_type AS route_id", "'R-' || CAST(user_id % 30 AS VARCHAR) AS route_id")

BUS_ENRICHED = _with(_ROUTED, """routes AS (
  SELECT 'R-' || CAST(s_nationkey AS VARCHAR) AS route_id, arg_max(s_name, s_suppkey) AS route_name, max(s_suppkey) AS k
  FROM supplier GROUP BY 1)""") + """
SELECT CASE WHEN r.k IS NULL THEN 'unmatched' ELSE 'enriched' END AS sink, b.route_id AS key, b.bus_id, b.route_id, b.lat, b.lon,
       b."timestamp", r.route_name, 'T-' || CAST(r.k AS VARCHAR) AS terminal, CAST(r.k % 60 AS VARCHAR) AS frequency_min
FROM bus_gps b LEFT JOIN routes r ON b.route_id = r.route_id"""

ENRICHMENT_COUNTERS = f"""
SELECT COUNT(*) AS events, COUNT(*) FILTER (WHERE sink = 'enriched') AS joined, COUNT(*) FILTER (WHERE sink = 'unmatched') AS no_match
FROM ({BUS_ENRICHED})"""

DIMENSION_VIEW = _with(_ROUTED) + """
SELECT b.route_id, 'T-' || CAST(s.s_suppkey AS VARCHAR) AS terminal, CAST(s.s_suppkey % 60 AS INTEGER) AS frequency_min, b.positions, b.buses
FROM supplier s JOIN (SELECT route_id, COUNT(*) AS positions, COUNT(DISTINCT bus_id) AS buses FROM bus_gps GROUP BY 1) b
  ON b.route_id = 'R-' || CAST(s.s_nationkey AS VARCHAR)"""

INCIDENT_SINK = f"""
WITH a AS ({ALERTS_COOLDOWN}),
g AS ({ALERTS_CONSECUTIVE}),
b AS ({STREAM_BUNCHING_CLOCK.replace("round(r.distance_m, 3) AS distance_m", "r.distance_m")})
SELECT incident_type AS key, incident_type, sensor_id, NULL::VARCHAR AS junction_id, zone, NULL::VARCHAR AS route_id, NULL::VARCHAR AS bus_1,
       NULL::VARCHAR AS bus_2, CAST(aqi AS DOUBLE) AS aqi, pm25, CAST(threshold AS DOUBLE) AS threshold, NULL::DOUBLE AS avg_wait_sec,
       NULL::INTEGER AS consecutive_readings, NULL::DOUBLE AS distance_m, NULL::DOUBLE AS duration_sec, message, event_time, TRUE AS stamped FROM a
UNION ALL
SELECT incident_type, incident_type, NULL, junction_id, zone, NULL, NULL, NULL, NULL, NULL, NULL, avg_wait_sec, consecutive_readings, NULL, NULL,
       message, event_time, TRUE FROM g
UNION ALL
SELECT 'BUS_BUNCHING', 'BUS_BUNCHING', NULL, NULL, NULL, route_id, bus_1, bus_2, NULL, NULL, NULL, NULL, NULL,
       round(distance_m, 1), CAST(printf('%.0f', duration_sec) AS DOUBLE),
       'BUNCHING on route ' || route_id || ': buses ' || bus_1 || ' & ' || bus_2 || ' within '
         || printf('%.0f', distance_m) || 'm for ' || printf('%.1f', duration_sec / 60) || ' min', event_time, TRUE FROM b"""

CONSUMERS = """
SELECT c.consumer, e.event_type AS zone, COUNT(*) AS messages FROM events e, (VALUES ('fast'), ('slow')) AS c(consumer) GROUP BY 1, 2"""

REPORT_EXPORTS = f"""
SELECT f.format, w.* FROM ({WEEKLY}) w, (VALUES ('csv'), ('json'), ('parquet')) AS f(format)"""

ORACLE: dict[str, str] = {
    # jobs on archived topics, read back from their sinks
    "stream_dlq_sink": DLQ_ENVELOPE,
    "stream_bus_enriched": BUS_ENRICHED,
    "stream_enrichment_counters": ENRICHMENT_COUNTERS,
    "dimension_view": DIMENSION_VIEW,
    "stream_incident_sink": INCIDENT_SINK,
    "stream_ward_energy_live": WARD_ENERGY_LIVE,
    "stream_independent_consumers": CONSUMERS,
    "report_exports": REPORT_EXPORTS,
    "dlq_report_5m": DLQ_REPORT_5M,
    "dlq_errors_5m": DLQ_ERRORS_5M,
    "enrich_last_file_row_wins": ENRICH_LAST_ROW_WINS,
    "stream_dlq_report_5m": DLQ_REPORT_5M,
    "stream_dlq_errors_5m": DLQ_ERRORS_5M,
    "stream_ward_energy_flushed": WARD_ENERGY,
    "stream_late_events": LATE_EVENTS,
    "stream_ward_energy_two_sinks": WARD_ENERGY_TWO_SINKS,
    "stream_weekly_ward_report": WEEKLY,
    "stream_advisory_archive_flushed": STREAM_ADVISORY_ARCHIVE_ALL,
    "stream_ward_energy_upsert": WARD_ENERGY,
    "stream_aqi_history": AQI_HISTORY,
    # streaming forms answer the same questions as their batch forms
    "stream_ward_energy": WARD_ENERGY,
    "stream_zone_advisory": ZONE_ADVISORY,
    "stream_rolling_avg_slide": ROLLING_SLIDE,
    "stream_alerts_cooldown": ALERTS_COOLDOWN,
    "stream_alerts_consecutive": ALERTS_CONSECUTIVE,
    "stream_enrich_lookup": ENRICH_LOOKUP,
    "stream_enrich_unmatched": ENRICH_UNMATCHED,
    "ward_energy_15m": WARD_ENERGY,
    "zone_avg_10m": ZONE_AVG,
    "rolling_avg_slide": ROLLING_SLIDE,
    "zone_advisory": ZONE_ADVISORY,
    "downsample_6h": DOWNSAMPLE,
    "latest_per_sensor": LATEST,
    "retention_7d": RETENTION,
    "weekly_ward_report": WEEKLY,
    "monthly_aqi_trend": MONTHLY,
    "ward_rerun_remap": REMAP,
    "enrich_lookup": ENRICH_LOOKUP,
    "enrich_unmatched": ENRICH_UNMATCHED,
    "enrich_left_default": ENRICH_LEFT,
    "enrich_counts": ENRICH_COUNTS,
    "json_decode": JSON_DECODE,
    "dlq_errors": DLQ_ERRORS,
    "dlq_split": DLQ_SPLIT,
    "dlq_summary": DLQ_SUMMARY,
    "dlq_report_totals": DLQ_REPORT_TOTALS,
    "fractional_readings": FRACTIONAL_READINGS,
    "enrich_last_row_wins": ENRICH_LAST_ROW_WINS,
    "dlq_error_distribution": DLQ_DIST,
    "dlq_error_types": DLQ_TYPES,
    "dlq_replay": DLQ_REPLAY,
    "dlq_top_errors": DLQ_TOP,
    "dlq_envelope": DLQ_ENVELOPE,
    "stream_dlq_summary": DLQ_SUMMARY,
    "alerts_cooldown": ALERTS_COOLDOWN,
    "alerts_consecutive": ALERTS_CONSECUTIVE,
    "proximity_pairs": PROXIMITY_PAIRS,
    "proximity_incidents": PROXIMITY_INCIDENTS,
    "late_events": LATE_EVENTS,
    "dlq_replay_repaired": DLQ_REPLAY_REPAIRED,
    "keyed_json_round_trip": KEYED_JSON_ROUND_TRIP,
    "keyed_export_order": KEYED_EXPORT_ORDER,
    "zone_avg_null_aqi": ZONE_AVG_NULL_AQI,
    "presented_ward_energy": PRESENTED_WARD_ENERGY,
    "stream_ward_energy_final": STREAM_WARD_ENERGY_FINAL,
    "stream_advisory_archive": STREAM_ADVISORY_ARCHIVE,
    "stream_bunching_clock": STREAM_BUNCHING_CLOCK,
    "incidents_union": INCIDENTS_UNION,
    "incident_counts": INCIDENT_COUNTS,
    "domain_scalars": DOMAIN_SCALARS,
}
