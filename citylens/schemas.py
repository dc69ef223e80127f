"""Explicit schemas for the telemetry streams, dimensions and outputs.

No inference anywhere: every stream is decoded against one of these.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, I, L, TS = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# -- input streams (one JSON object per event) -------------------------------
AIR_QUALITY = _struct(("sensor_id", S), ("zone", S), ("pm25", D), ("pm10", D),
                      ("no2", D), ("aqi", D), ("timestamp", TS))
BUS_GPS = _struct(("bus_id", S), ("route_id", S), ("lat", D), ("lon", D),
                  ("speed_kmh", D), ("occupancy_pct", I), ("timestamp", TS))
TRAFFIC_SIGNALS = _struct(("junction_id", S), ("zone", S), ("vehicle_count", I),
                          ("avg_wait_sec", D), ("signal_phase", S), ("timestamp", TS))
SMART_METERS = _struct(("meter_id", S), ("ward_id", S), ("kwh_reading", D),
                       ("voltage", D), ("power_factor", D), ("timestamp", TS))

# -- static dimensions --------------------------------------------------------
ZONE_PROFILE = _struct(("zone_id", S), ("zone", S), ("zone_name", S), ("population", I),
                       ("num_schools", I), ("num_hospitals", I))
# frequency_min stays a string, as in the source CSV; cast on request.
ROUTE_SCHEDULE = _struct(("route_id", S), ("route_name", S), ("terminal", S),
                         ("scheduled_arrival_time", S), ("frequency_min", S))

# -- message-bus envelope (what a Kafka source yields) -----------------------
ENVELOPE = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", S, True),
    T.StructField("partition", I, True),
    T.StructField("offset", L, True),
    T.StructField("timestamp", TS, True),
])

# Stream catalogue: logical stream -> (schema, key column, partitions, retention).
# Fixed values of the deployment being modelled.
STREAMS = {
    "bus_gps": (BUS_GPS, "route_id", 40, "24 hours"),
    "traffic_signals": (TRAFFIC_SIGNALS, "junction_id", 15, "7 days"),
    "air_quality": (AIR_QUALITY, "sensor_id", 10, "90 days"),
    "smart_meters": (SMART_METERS, "meter_id", 20, "365 days"),
    "incidents": (None, "incident_type", 5, "30 days"),
    "dlq": (None, "original_topic", 3, "7 days"),
    "health_advisories": (None, "zone", 5, "30 days"),
    "ward_energy_summary": (None, "ward_id", 10, "30 days"),
    "bus_gps_enriched": (None, "route_id", 40, "24 hours"),
}


def stream_schema(name: str) -> T.StructType:
    schema = STREAMS[name][0]
    if schema is None:
        raise KeyError(f"{name} is an output stream without an input schema")
    return schema


def stream_key(name: str) -> str:
    return STREAMS[name][1]


def retention(name: str) -> str:
    return STREAMS[name][3]
