"""The generated benchmark tables dressed as the four telemetry streams.

The driver's tables (``events``, ``orders``, ``customer`` ...) carry no city
data, so each stream is *derived* from them column by column: the work of
every query still grows with the tables.  Each Spark builder has a twin SQL
CTE (``*_SQL``) with the same arithmetic, used by the independent oracle.
The two must change together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import aqi_from_pm25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# -- smart meters: ward = event_type, kwh = value --------------------------------
def smart_meters(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.concat(F.lit("MTR-"), F.col("user_id").cast("string")).alias("meter_id"),
        F.col("event_type").alias("ward_id"),
        F.col("value").alias("kwh_reading"),
        (F.lit(210) + F.col("event_id") % 40).cast("double").alias("voltage"),
        ((F.lit(80) + F.col("event_id") % 20).cast("double") / 100).alias("power_factor"),
        F.col("ts").alias("timestamp"),
        "event_id", "user_id")


SMART_METERS_SQL = """smart_meters AS (
  SELECT 'MTR-' || CAST(user_id AS VARCHAR) AS meter_id, event_type AS ward_id,
         value AS kwh_reading, CAST(210 + event_id % 40 AS DOUBLE) AS voltage,
         CAST(80 + event_id % 20 AS DOUBLE) / 100 AS power_factor, ts AS "timestamp",
         event_id, user_id
  FROM events)"""


# -- air quality: zone = event_type, pm25 = value, aqi from pm25 --------------------
def air_quality(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.concat(F.lit("AQ-"), F.col("user_id").cast("string")).alias("sensor_id"),
        F.col("event_type").alias("zone"),
        F.col("value").alias("pm25"),
        aqi_from_pm25(F.col("value")).alias("aqi"),
        F.col("ts").alias("timestamp"),
        "event_id", "user_id")


AIR_QUALITY_SQL = """air_quality AS (
  SELECT 'AQ-' || CAST(user_id AS VARCHAR) AS sensor_id, event_type AS zone, value AS pm25,
         CAST(TRUNC(LEAST(GREATEST(value * 2.5, 0.0), 500.0)) AS INTEGER) AS aqi,
         ts AS "timestamp", event_id, user_id
  FROM events)"""


# -- traffic signals: junction = user, wait = whole seconds of value ----------------
def traffic_signals(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.concat(F.lit("JUNC-"), F.col("user_id").cast("string")).alias("junction_id"),
        F.col("event_type").alias("zone"),
        F.floor("value").cast("int").alias("avg_wait_sec"),
        F.col("ts").alias("timestamp"),
        "event_id", "user_id")


TRAFFIC_SQL = """traffic AS (
  SELECT 'JUNC-' || CAST(user_id AS VARCHAR) AS junction_id, event_type AS zone,
         CAST(FLOOR(value) AS INTEGER) AS avg_wait_sec, ts AS "timestamp", event_id, user_id
  FROM events)"""


# -- bus GPS: route = event_type, 12 buses, positions on a ~80 m lattice -----------
def bus_gps(ev: DataFrame, *keep) -> DataFrame:
    return ev.select(
        F.concat(F.lit("BUS-"), F.lpad((F.col("user_id") % 12).cast("string"), 2, "0")).alias("bus_id"),
        F.col("event_type").alias("route_id"),
        ((F.lit(129500) + (F.col("event_id") % 11) * 7).cast("double") / 10000).alias("lat"),
        ((F.lit(776000) + (F.col("event_id") % 13) * 7).cast("double") / 10000).alias("lon"),
        F.col("ts").alias("timestamp"),
        "event_id", *keep)


BUS_GPS_SQL = """bus_gps AS (
  SELECT 'BUS-' || lpad(CAST(user_id % 12 AS VARCHAR), 2, '0') AS bus_id, event_type AS route_id,
         CAST(129500 + (event_id % 11) * 7 AS DOUBLE) / 10000 AS lat,
         CAST(776000 + (event_id % 13) * 7 AS DOUBLE) / 10000 AS lon,
         ts AS "timestamp", event_id
  FROM events)"""


# -- one mixed raw stream of all four topics (for the DLQ validator) ---------------
# topic by event type; payload = the topic's fields as JSON text, NULLs omitted; every
# 53rd message is broken text.  Field values are chosen so that each rule fires
# on some rows and the boundary values of the box occur.
TOPIC_OF_TYPE = {"click": "bus_gps", "view": "smart_meters", "error": "air_quality",
                 "signup": "traffic_signals", "purchase": "traffic_signals"}


def raw_mixed(ev: DataFrame) -> DataFrame:
    et, eid, uid, v = F.col("event_type"), F.col("event_id"), F.col("user_id"), F.col("value")
    topic = F.when(et == "click", "bus_gps").when(et == "view", "smart_meters") \
        .when(et == "error", "air_quality").otherwise("traffic_signals")
    dbl = lambda c: c.cast("string")  # noqa: E731  (shortest round-trip text)
    aq = F.format_string('{"sensor_id":"AQ-%d",%s"pm25":%s,"pm10":%s}', uid,
                         F.when(eid % 20 != 0, F.format_string('"aqi":%d,', (v * 2).cast("int")))
                         .otherwise(F.lit("")),
                         dbl(F.round(v - 2, 2)), dbl(F.round(v - 1, 2)))
    bus = F.format_string('{"bus_id":"BUS-%d","lat":%s,"lon":%s,"speed_kmh":%s}', uid,
                          dbl((F.lit(1286) + eid % 28).cast("double") / 100),
                          dbl((F.lit(7746) + eid % 31).cast("double") / 100),
                          dbl(F.round(v - 5, 2)))
    tr = F.format_string('{%s"avg_wait_sec":%d,"vehicle_count":%d}',
                         F.when(uid % 30 != 0, F.format_string('"junction_id":"JUNC-%d",', uid))
                         .otherwise(F.lit("")),
                         F.floor(v).cast("int") - 3, (eid % 50 - 2).cast("int"))
    mt = F.format_string('{%s"voltage":%s,"power_factor":%s}',
                         F.when(uid % 25 != 0, F.format_string('"meter_id":"MTR-%d",', uid))
                         .otherwise(F.lit("")),
                         dbl((F.lit(1950) + eid % 700).cast("double") / 10),
                         dbl((eid % 105).cast("double") / 100))
    body = (F.when(topic == "air_quality", aq).when(topic == "bus_gps", bus)
            .when(topic == "traffic_signals", tr).otherwise(mt))
    payload = F.when(eid % 53 == 0, F.lit("{broken")).otherwise(body)
    return ev.select("event_id", F.col("ts").alias("timestamp"), topic.alias("topic"),
                     payload.alias("payload"))


# The oracle does not parse JSON: it recomputes the same field values.
RAW_FIELDS_SQL = """raw AS (
  SELECT event_id, ts AS "timestamp",
         CASE event_type WHEN 'click' THEN 'bus_gps' WHEN 'view' THEN 'smart_meters'
              WHEN 'error' THEN 'air_quality' ELSE 'traffic_signals' END AS topic,
         event_id % 53 = 0 AS broken,
         CASE WHEN event_id % 20 <> 0 THEN CAST(TRUNC(value * 2) AS INTEGER) END AS aqi,
         round(value - 2, 2) AS pm25, round(value - 1, 2) AS pm10,
         CAST(1286 + event_id % 28 AS DOUBLE) / 100 AS lat,
         CAST(7746 + event_id % 31 AS DOUBLE) / 100 AS lon,
         round(value - 5, 2) AS speed_kmh,
         CASE WHEN user_id % 30 <> 0 THEN 'JUNC-' || CAST(user_id AS VARCHAR) END AS junction_id,
         CAST(FLOOR(value) AS INTEGER) - 3 AS avg_wait_sec,
         CAST(event_id % 50 - 2 AS INTEGER) AS vehicle_count,
         CASE WHEN user_id % 25 <> 0 THEN 'MTR-' || CAST(user_id AS VARCHAR) END AS meter_id,
         CAST(1950 + event_id % 700 AS DOUBLE) / 10 AS voltage,
         CAST(event_id % 105 AS DOUBLE) / 100 AS power_factor,
         CASE WHEN event_id % 53 = 0 THEN '{broken'
              WHEN event_type = 'error' THEN '{"sensor_id":"AQ-' || CAST(user_id AS VARCHAR) || '",'
                || CASE WHEN event_id % 20 <> 0 THEN '"aqi":' || CAST(CAST(TRUNC(value * 2) AS INTEGER) AS VARCHAR) || ',' ELSE '' END
                || '"pm25":' || CAST(round(value - 2, 2) AS VARCHAR) || ',"pm10":' || CAST(round(value - 1, 2) AS VARCHAR) || '}'
              WHEN event_type = 'click' THEN '{"bus_id":"BUS-' || CAST(user_id AS VARCHAR) || '","lat":'
                || CAST(CAST(1286 + event_id % 28 AS DOUBLE) / 100 AS VARCHAR) || ',"lon":'
                || CAST(CAST(7746 + event_id % 31 AS DOUBLE) / 100 AS VARCHAR) || ',"speed_kmh":'
                || CAST(round(value - 5, 2) AS VARCHAR) || '}'
              WHEN event_type = 'view' THEN '{'
                || CASE WHEN user_id % 25 <> 0 THEN '"meter_id":"MTR-' || CAST(user_id AS VARCHAR) || '",' ELSE '' END
                || '"voltage":' || CAST(CAST(1950 + event_id % 700 AS DOUBLE) / 10 AS VARCHAR)
                || ',"power_factor":' || CAST(CAST(event_id % 105 AS DOUBLE) / 100 AS VARCHAR) || '}'
              ELSE '{'
                || CASE WHEN user_id % 30 <> 0 THEN '"junction_id":"JUNC-' || CAST(user_id AS VARCHAR) || '",' ELSE '' END
                || '"avg_wait_sec":' || CAST(CAST(FLOOR(value) AS INTEGER) - 3 AS VARCHAR)
                || ',"vehicle_count":' || CAST(CAST(event_id % 50 - 2 AS INTEGER) AS VARCHAR) || '}'
         END AS payload
  FROM events)"""

# Per-topic error lists, in rule order (DuckDB list_filter drops the NULLs).
ERRORS_SQL = """checked AS (
  SELECT event_id, "timestamp", topic, payload,
    CASE WHEN broken THEN ['json_parse_error:payload is not a JSON object']
    ELSE list_filter(CASE topic
      WHEN 'air_quality' THEN [
        CASE WHEN aqi IS NULL THEN 'null_aqi' END,
        CASE WHEN aqi IS NOT NULL AND NOT (aqi BETWEEN 0 AND 500)
             THEN 'aqi_out_of_range:' || CAST(aqi AS VARCHAR) END,
        CASE WHEN pm25 < 0 THEN 'negative_pm25' END,
        CASE WHEN pm10 < 0 THEN 'negative_pm10' END]
      WHEN 'bus_gps' THEN [
        CASE WHEN NOT (lat BETWEEN 12.88 AND 13.12) THEN 'impossible_lat:' || CAST(lat AS VARCHAR) END,
        CASE WHEN NOT (lon BETWEEN 77.48 AND 77.75) THEN 'impossible_lon:' || CAST(lon AS VARCHAR) END,
        CASE WHEN speed_kmh < 0 THEN 'negative_speed:' || CAST(speed_kmh AS VARCHAR) END,
        CASE WHEN speed_kmh > 120 THEN 'speed_too_high:' || CAST(speed_kmh AS VARCHAR) END]
      WHEN 'traffic_signals' THEN [
        CASE WHEN avg_wait_sec < 0 THEN 'negative_wait_sec' END,
        CASE WHEN vehicle_count < 0 THEN 'negative_vehicle_count' END,
        CASE WHEN junction_id IS NULL THEN 'null_junction_id' END]
      ELSE [
        CASE WHEN NOT (voltage BETWEEN 200 AND 260) THEN 'voltage_out_of_range:' || CAST(voltage AS VARCHAR) END,
        CASE WHEN NOT (power_factor BETWEEN 0.0 AND 1.0) THEN 'power_factor_invalid:' || CAST(power_factor AS VARCHAR) END,
        CASE WHEN meter_id IS NULL THEN 'null_meter_id' END]
      END, lambda x: x IS NOT NULL) END AS errors
  FROM raw)"""


# -- zone profile for the event-type zones (a 4-row static dimension; 'purchase'
#    deliberately has no profile, to exercise the left-join defaults) ---------------
ZONE_PROFILE_ROWS = [
    ("Z-click", "click", "Click Metro", 320000, 28, 4),
    ("Z-view", "view", "View Metro", 415000, 35, 6),
    ("Z-error", "error", "Error Metro", 280000, 22, 3),
    ("Z-signup", "signup", "Signup Metro", 1195000, 18, 8),
]


def zone_profile(spark: SparkSession) -> DataFrame:
    from ..schemas import ZONE_PROFILE
    return spark.createDataFrame(ZONE_PROFILE_ROWS, ZONE_PROFILE)


def zone_profile_sql() -> str:
    vals = ", ".join(f"('{a}', '{b}', '{c}', {d}, {e}, {f})" for a, b, c, d, e, f in ZONE_PROFILE_ROWS)
    return (f"zone_profile AS (SELECT * FROM (VALUES {vals}) "
            f"AS t(zone_id, zone, zone_name, population, num_schools, num_hospitals))")


# -- orders enriched with customers of every segment but BUILDING ------------------
def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") != "BUILDING")
            .select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_nationkey", "c_mktsegment"))


CUSTOMER_DIM_SQL = """cdim AS (
  SELECT c_custkey AS o_custkey, c_name, c_nationkey, c_mktsegment
  FROM customer WHERE c_mktsegment <> 'BUILDING')"""
