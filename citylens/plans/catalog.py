"""Registered queries: each operator family run over the driver's tables.

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
*whole* input tables (no sampling, no id subsets).  The SQL twins live in
``oracle.py``; column names match one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.codec import decode, encode
from ..functions.geo import haversine_m
from ..functions.scalar import (advisory_level, advisory_text, aqi_from_pm25, bucket_label, epoch_seconds, fixed,
                                fixed_sum, parse_iso_ts, py_round)
from ..operators import detect, enrich, quality, windows
from ..operators.reports import present_ward_energy
from ..operators.sequence import keyed_position
from ..session import prepare, scratch_path
from ..sources.dims import read_dimension
from . import mapping as M

# Parameters of the mapped detectors (events are ~4 min apart per event type
# at sf0.01 and hours apart per user, so spans are hours / days).
AQI_ALERT_ABOVE = 250            # aqi > 250 ~ value > 100
AQI_COOLDOWN = "2 days"
WAIT_ABOVE = 40
WAIT_N = 3
WAIT_WITHIN = "3 days"
BUNCH_DISTANCE_M = 250.0
BUNCH_GAP = "30 minutes"
BUNCH_ISLAND_GAP = "2 hours"
BUNCH_MIN_DURATION = "1 hour"
LATE_SHIFT_HOURS = 7             # event time = ts - (event_id % 7) hours
LATENESS = "2 hours"
ADVISORY_ABOVE = 150.0
RETENTION_AS_OF = "2024-01-31 00:00:00"
REPORT_EVERY = "5 minutes"
REPORT_TOPICS = [*quality.RULES, "parking"]


def _ev(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return M.events(spark, sf)


# ---------------------------------------------------------------- aggregates
def ward_energy_15m(spark, sf):
    return windows.ward_energy(M.smart_meters(_ev(spark, sf)))


def zone_avg_10m(spark, sf):
    return windows.zone_aqi(M.air_quality(_ev(spark, sf)))


def rolling_avg_slide(spark, sf):
    return windows.zone_aqi(M.air_quality(_ev(spark, sf)), every="10 minutes", slide="5 minutes")


def advisories(avg: DataFrame, profile: DataFrame, above: float = ADVISORY_ABOVE) -> DataFrame:
    """Window averages above the threshold, joined to the zone profile
    (unknown zones kept, named after the zone), with level and text."""
    j = enrich.enrich(avg.filter(F.col("rolling_avg_aqi") > above), profile.drop("zone_id"),
                      "zone", "left", max_broadcast_rows=10_000)
    j = j.withColumn("zone_name", F.coalesce("zone_name", "zone"))
    lvl = advisory_level("rolling_avg_aqi")
    return j.select("zone", "zone_name", "window_start", "window_end", "rolling_avg_aqi",
                    "population", "num_schools", "num_hospitals", "sensor_readings",
                    lvl.alias("advisory_level"),
                    advisory_text("zone_name", lvl, "rolling_avg_aqi", "num_schools",
                                  "num_hospitals", "population").alias("advisory_text"))


def zone_advisory(spark, sf):
    return advisories(zone_avg_10m(spark, sf), M.zone_profile(spark))


def downsample_6h(spark, sf):
    aq = M.air_quality(_ev(spark, sf))
    return windows.downsample(aq, "timestamp", ["sensor_id"], "pm25", "6 hours")


def latest_per_sensor(spark, sf):
    aq = M.air_quality(_ev(spark, sf))
    return windows.latest_per_key(aq, ["sensor_id"], ["timestamp", "event_id"],
                                  ["timestamp", "zone", "aqi", "event_id"])


def retention_7d(spark, sf):
    ev = _ev(spark, sf)
    return windows.retain(ev, "ts", "7 days", RETENTION_AS_OF).select(
        "event_id", "user_id", "event_type", "ts")


def weekly_ward_report(spark, sf):
    w = ward_energy_15m(spark, sf)
    week = F.date_trunc("week", "window_start").cast("timestamp_ntz")
    return (w.groupBy(week.alias("week_start"), "ward_id")
             .agg(fixed_sum("total_kwh_consumed").alias("total_kwh"),
                  F.max("peak_voltage").alias("peak_voltage"),
                  F.count(F.lit(1)).alias("windows")))


def monthly_aqi_trend(spark, sf):
    aq = M.air_quality(_ev(spark, sf)).filter(F.col("aqi").isNotNull())
    m = (aq.groupBy("zone", F.date_trunc("month", "timestamp").cast("timestamp_ntz").alias("month"))
           .agg((F.sum(F.col("aqi").cast("long")) / F.count("aqi")).alias("avg_aqi"),
                F.max("aqi").alias("max_aqi"), F.count(F.lit(1)).alias("readings")))
    # one row per zone and month: the window below sorts a handful of rows
    w = Window.partitionBy("zone").orderBy("month")
    return m.withColumn("change", F.col("avg_aqi") - F.lag("avg_aqi").over(w))


def ward_rerun_remap(spark, sf):
    """Re-run of the ward summary after a boundary change: meters move to
    the ward of their customer's nation (unknown -> UNKNOWN)."""
    meters = M.smart_meters(_ev(spark, sf))
    wards = M.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.concat(F.lit("WARD-"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0")).alias("new_ward"))
    moved = enrich.enrich_with_defaults(meters, wards, "user_id", {"new_ward": "UNKNOWN"})
    return windows.ward_energy(moved.drop("ward_id").withColumnRenamed("new_ward", "ward_id"),
                               every="1 hour")


# ---------------------------------------------------------------- enrichment
def _orders(spark, sf):
    prepare(spark)
    return M.table(spark, sf, "orders")


def enrich_lookup(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return enrich.enrich(o, M.customer_dim(spark, sf), "o_custkey", "inner")


def enrich_unmatched(spark, sf):
    return enrich.unmatched(_orders(spark, sf), M.customer_dim(spark, sf), "o_custkey")


def enrich_left_default(spark, sf):
    o = _orders(spark, sf).select("o_orderkey", "o_custkey")
    return enrich.enrich_with_defaults(o, M.customer_dim(spark, sf), "o_custkey",
                                       {"c_name": "UNKNOWN", "c_mktsegment": "N/A"})


def enrich_counts(spark, sf):
    return enrich.match_counts(_orders(spark, sf), M.customer_dim(spark, sf), "o_custkey")


# ---------------------------------------------------------------- decode / quality
def json_decode(spark, sf):
    ev = _ev(spark, sf)
    return decode(ev, "k INT", value="props", keep=("event_id",))


def _checked(spark, sf) -> DataFrame:
    raw = M.raw_mixed(_ev(spark, sf))
    return quality.validate_payloads(raw, "topic", "payload")


def dlq_errors(spark, sf):
    return quality.explode_errors(_checked(spark, sf), ["event_id", "topic"])


def dlq_split(spark, sf):
    return _checked(spark, sf).select("event_id", "topic", "is_valid",
                                      F.size("errors").alias("n_errors"), "error_reason")


def dlq_summary(spark, sf):
    return quality.dlq_summary(_checked(spark, sf))


def dlq_report_totals(spark, sf):
    """The validator's report: per topic (listed topics without a message
    included) and in total."""
    s = quality.dlq_summary(_checked(spark, sf))
    return quality.report_totals(s, [*quality.RULES, "parking"])


def enrich_last_row_wins(spark, sf):
    """Customers joined to a dimension with several rows per key (orders by
    customer): the last row, by order key, wins."""
    prepare(spark)
    dim = M.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    return enrich.enrich(M.table(spark, sf, "customer").select("c_custkey", "c_name"), dim, "c_custkey", "inner", dedupe_by="o_orderkey")


def fractional_readings(spark, sf):
    """Readings with fractions (eight times the value as AQI, the value less 20
    as waiting time), compared as sent."""
    ev = _ev(spark, sf)
    topic = F.when(F.col("event_id") % 2 == 0, "air_quality").otherwise("traffic_signals")
    aqi = F.concat(F.lit('{"aqi": '), (F.col("value") * 8).cast("string"), F.lit("}"))
    wait = F.concat(F.lit('{"junction_id": "J", "avg_wait_sec": '), (F.col("value") - 20).cast("string"), F.lit("}"))
    raw = ev.select("event_id", topic.alias("topic"), F.when(F.col("event_id") % 2 == 0, aqi).otherwise(wait).alias("payload"))
    return quality.validate_payloads(raw, "topic", "payload").select("event_id", "is_valid", "error_reason")


def dlq_report_5m(spark, sf):
    """The validator's report per 5 minutes of event time: per topic (listed
    topics without a message included) and in total."""
    counts = quality.windowed_counts(_checked(spark, sf), "timestamp", REPORT_EVERY)
    return quality.windowed_report(counts, REPORT_TOPICS)


def dlq_errors_5m(spark, sf):
    """The error distribution per 5 minutes of event time."""
    return quality.windowed_errors(quality.windowed_counts(_checked(spark, sf), "timestamp", REPORT_EVERY))


def enrich_last_file_row_wins(spark, sf):
    """Customers joined to a dimension that lies in several CSV files of
    different sizes (orders by customer, in order of the order key): of the rows of a key
    the last one of the last file wins."""
    prepare(spark)
    path = scratch_path(spark, "dimension")
    orders = M.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderpriority")
    orders.repartitionByRange(5, "o_orderkey").sortWithinPartitions("o_orderkey").write.option("header", "true").csv(path)
    dim = read_dimension(spark, path, orders.schema)
    return enrich.enrich(M.table(spark, sf, "customer").select("c_custkey", "c_name"), enrich.last_row_wins(dim, ["c_custkey"]), "c_custkey", "inner")


def dlq_error_distribution(spark, sf):
    return quality.error_distribution(_checked(spark, sf))


def dlq_error_types(spark, sf):
    return quality.error_distribution(_checked(spark, sf), by_type=True)


def dlq_top_errors(spark, sf):
    """The ten most frequent errors (a top-k report: the limit is the
    feature)."""
    from ..operators.reports import top_k
    d = quality.error_distribution(_checked(spark, sf))
    return top_k(d, [F.desc("count"), "topic", "error"], 10)


def dlq_envelope(spark, sf):
    chk = _checked(spark, sf)
    env = quality.dlq_envelope(chk, "topic", F.col("payload"), now=F.col("timestamp"))
    return env.select(F.col("original_topic").alias("key"), "original_topic", "error_reason",
                      F.size("all_errors").alias("n_errors"),
                      F.array_join("all_errors", "|").alias("all_errors"), "original_data")


def dlq_replay(spark, sf):
    """Replay of the dead letters: decode ``original_data`` again and
    re-validate; per topic and first error, how many now pass."""
    chk = _checked(spark, sf)
    env = quality.dlq_envelope(chk, "topic", F.col("payload"), now=F.col("timestamp"))
    again = quality.validate_payloads(env, "original_topic", "original_data")
    return (again.groupBy("original_topic", quality.error_type(F.col("error_reason")).alias("first_error"))
                 .agg(F.count_if("is_valid").alias("recovered"),
                      F.count_if(~F.col("is_valid")).alias("still_invalid")))


def dlq_replay_repaired(spark, sf):
    """Replay of the dead letters after a rule change (AQI is no longer
    bounded): how many per topic are recovered, how many stay dead."""
    chk = _checked(spark, sf)
    env = quality.dlq_envelope(chk, "topic", F.col("payload"), now=F.col("timestamp"))
    rules = {t: [r for r in rs if r.name != "aqi_out_of_range"] for t, rs in quality.RULES.items()}
    again = quality.validate_payloads(env, "original_topic", "original_data", rules=rules)
    return again.groupBy("original_topic", F.col("is_valid").alias("recovered")).agg(F.count(F.lit(1)).alias("messages"))


def keyed_json_round_trip(spark, sf):
    """Readings as keyed JSON messages, and what a consumer decodes from them."""
    ev = _ev(spark, sf).select(F.col("event_type").alias("zone"), "event_id", "value")
    msgs = encode(ev, "zone")
    return decode(msgs, "zone STRING, event_id LONG, value DOUBLE", keep=("key",))


def keyed_export_order(spark, sf):
    """Readings in per-key order (by event time): the position of each among
    the readings of its key."""
    ev = _ev(spark, sf).select("user_id", "ts", "event_id")
    return keyed_position(ev, ["user_id"], ["ts", "event_id"])


def zone_avg_null_aqi(spark, sf):
    """Zone averages where every tenth sensor reading is a fault (null AQI)."""
    aq = M.air_quality(_ev(spark, sf))
    return windows.zone_aqi(aq.withColumn("aqi", F.when(F.col("event_id") % 10 != 0, F.col("aqi"))))


def presented_ward_energy(spark, sf):
    """Ward summaries as shown: half-even rounding of kWh, factor, voltage."""
    return present_ward_energy(ward_energy_15m(spark, sf))


# ---------------------------------------------------------------- detectors
def alerts_cooldown(spark, sf):
    aq = M.air_quality(_ev(spark, sf))
    a = detect.cooldown_alerts(aq, "sensor_id", "timestamp", F.col("aqi") > AQI_ALERT_ABOVE,
                               AQI_COOLDOWN, id_col="event_id")
    return a.select(F.lit("AQI_EMERGENCY").alias("incident_type"), "sensor_id", "zone", "aqi", "pm25",
                    F.lit(AQI_ALERT_ABOVE).alias("threshold"),
                    F.format_string("HAZARDOUS AQI %d at sensor %s zone %s",
                                    "aqi", "sensor_id", "zone").alias("message"),
                    F.col("timestamp").alias("event_time"), "event_id")


def alerts_consecutive(spark, sf):
    tr = M.traffic_signals(_ev(spark, sf))
    g = detect.consecutive_breach(tr, "junction_id", "timestamp", "avg_wait_sec", WAIT_ABOVE,
                                  WAIT_N, WAIT_WITHIN, order=["event_id"])
    return g.select(F.lit("TRAFFIC_GRIDLOCK").alias("incident_type"), "junction_id", "zone",
                    py_round("avg_last_n", 1).alias("avg_wait_sec"), "consecutive_readings",
                    F.format_string("GRIDLOCK at %s zone %s — avg wait %ss for %d cycles",
                                    "junction_id", "zone", fixed("avg_last_n", 0),
                                    "consecutive_readings").alias("message"),
                    F.col("timestamp").alias("event_time"), "event_id")


def proximity_pairs(spark, sf):
    bus = M.bus_gps(_ev(spark, sf))
    p = detect.proximity_pairs(bus, "route_id", "bus_id", "timestamp", "lat", "lon",
                               BUNCH_DISTANCE_M, BUNCH_GAP, id_col="event_id")
    return p.withColumn("distance_m", F.round("distance_m", 3))


def proximity_incidents(spark, sf):
    bus = M.bus_gps(_ev(spark, sf))
    p = detect.proximity_pairs(bus, "route_id", "bus_id", "timestamp", "lat", "lon",
                               BUNCH_DISTANCE_M, BUNCH_GAP, id_col="event_id")
    inc = detect.proximity_incidents(p, "route_id", "bus_id", BUNCH_MIN_DURATION, BUNCH_ISLAND_GAP)
    return inc.select("route_id", "bus_id_1", "bus_id_2", "start_time", "end_time", "sightings",
                      F.round("min_distance_m", 3).alias("min_distance_m"), "duration_sec")


def late_events(spark, sf):
    ev = _ev(spark, sf).select(
        "event_id", "event_type",
        (F.col("ts") - F.make_dt_interval(hours=(F.col("event_id") % LATE_SHIFT_HOURS).cast("int")))
        .alias("event_time"))
    m = detect.mark_late(ev, "event_type", "event_time", "event_id", LATENESS)
    return m.filter("is_late").select("event_id", "event_type", "event_time")


def incidents_union(spark, sf):
    """The incident job as a batch run: late drop per stream, the three
    detectors, one incident shape."""
    ev = _ev(spark, sf)
    return detect.incidents(M.air_quality(ev), M.traffic_signals(ev), M.bus_gps(ev), arrival="event_id",
                            lateness="30 seconds", aqi_above=AQI_ALERT_ABOVE, cooldown=AQI_COOLDOWN,
                            wait_above=WAIT_ABOVE, n=WAIT_N, within=WAIT_WITHIN,
                            distance_m=BUNCH_DISTANCE_M, gap=BUNCH_GAP, island_gap=BUNCH_ISLAND_GAP,
                            duration=BUNCH_MIN_DURATION).drop("alert_time").withColumn(
        "event_time", F.col("event_time").cast("timestamp_ntz"))


def incident_counts(spark, sf):
    return detect.incident_counts(incidents_union(spark, sf))


# ---------------------------------------------------------------- scalar functions
def domain_scalars(spark, sf):
    ev = _ev(spark, sf)
    bus = M.bus_gps(ev, "value")
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return bus.select(
        "event_id", aqi_from_pm25(F.col("value")).alias("aqi"),
        bucket_label("timestamp", 900).alias("bucket_15m"),
        F.to_date("timestamp").alias("event_date"),
        parse_iso_ts(iso).cast("timestamp_ntz").alias("parsed_ts"),
        F.round(haversine_m(F.lit(12.9716), F.lit(77.5946), "lat", "lon"), 3).alias("dist_center_m"),
        F.bround(F.col("lat").cast("decimal(12,4)"), 2).cast("double").alias("lat_2dp_even"),
        epoch_seconds("timestamp").alias("epoch_s"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "ward_energy_15m": ward_energy_15m,
    "zone_avg_10m": zone_avg_10m,
    "rolling_avg_slide": rolling_avg_slide,
    "zone_advisory": zone_advisory,
    "downsample_6h": downsample_6h,
    "latest_per_sensor": latest_per_sensor,
    "retention_7d": retention_7d,
    "weekly_ward_report": weekly_ward_report,
    "monthly_aqi_trend": monthly_aqi_trend,
    "ward_rerun_remap": ward_rerun_remap,
    "enrich_lookup": enrich_lookup,
    "enrich_unmatched": enrich_unmatched,
    "enrich_left_default": enrich_left_default,
    "enrich_counts": enrich_counts,
    "json_decode": json_decode,
    "dlq_errors": dlq_errors,
    "dlq_split": dlq_split,
    "dlq_summary": dlq_summary,
    "dlq_report_totals": dlq_report_totals,
    "fractional_readings": fractional_readings,
    "enrich_last_row_wins": enrich_last_row_wins,
    "dlq_error_distribution": dlq_error_distribution,
    "dlq_error_types": dlq_error_types,
    "dlq_top_errors": dlq_top_errors,
    "dlq_envelope": dlq_envelope,
    "dlq_replay": dlq_replay,
    "dlq_replay_repaired": dlq_replay_repaired,
    "keyed_json_round_trip": keyed_json_round_trip,
    "keyed_export_order": keyed_export_order,
    "zone_avg_null_aqi": zone_avg_null_aqi,
    "presented_ward_energy": presented_ward_energy,
    "alerts_cooldown": alerts_cooldown,
    "alerts_consecutive": alerts_consecutive,
    "proximity_pairs": proximity_pairs,
    "proximity_incidents": proximity_incidents,
    "late_events": late_events,
    "incidents_union": incidents_union,
    "incident_counts": incident_counts,
    "domain_scalars": domain_scalars,
    "dlq_report_5m": dlq_report_5m,
    "dlq_errors_5m": dlq_errors_5m,
    "enrich_last_file_row_wins": enrich_last_file_row_wins,
}
