"""Streaming job runners: attach a source, watermark and sinks to the
``DataFrame -> DataFrame`` operators.  Each returns the started queries.

All paths (outputs, checkpoints) should be absolute and on shared storage;
every query gets its own checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import decode
from ..functions.scalar import advisory_level, advisory_text
from ..operators import detect, enrich, quality, windows
from ..schemas import AIR_QUALITY, BUS_GPS, SMART_METERS, TRAFFIC_SIGNALS
from ..sources.streams import Flush, last_event_micros
from ..session import RECOMMENDED_CONF
from ..sinks import writers
from ..sinks.committed import CommittedTable, into_tables
from . import stateful
from .bunching import bunching_chained


# windows, watermarks and detectors need an event time: a message whose
# timestamp is missing or unparsable is skipped
EVENT_TIME = ("timestamp",)
# an event exactly 30 s behind is kept: Spark drops what is not after the watermark
LATENESS = "30 seconds 1 millisecond"


def _ck(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


# ------------------------------------------------------------------ ward energy (E2)
def ward_energy_job(raw: DataFrame, out_parquet: str, out_json: str | None, checkpoint_root: str,
                    watermark: str = "45 minutes", every: str = "15 minutes",
                    trigger: str | None = "5 seconds", kafka: dict | None = None,
                    decoded: bool = False, flush: Flush | None = None) -> list[StreamingQuery]:
    """Smart-meter envelope stream -> 15-min energy per ward, to a keyed
    JSON/Kafka sink in update mode and to Parquet partitioned by
    ``ward_id, date`` in append mode (finalised windows only).  Two queries,
    two state copies: their output modes differ.  With ``flush`` the windows
    still open can be emitted at the end (``stop_flushed``)."""
    ev = raw if decoded else decode(raw, SMART_METERS, require=EVENT_TIME)
    timed = flush.watermark(ev, watermark) if flush else ev.withWatermark("timestamp", watermark)
    agg = windows.ward_energy(timed, every=every)
    qs = []
    if out_json is not None or kafka is not None:
        qs.append(writers.start_keyed_json(agg, "ward_id", _ck(checkpoint_root, "ward_energy_kafka"),
                                           "update", trigger, out_json, kafka, name=None))
    qs.append(writers.start_parquet(agg, out_parquet, _ck(checkpoint_root, "ward_energy_parquet"),
                                    ["ward_id", "date"], trigger))
    return qs


def ward_energy_upsert_job(raw: DataFrame, out_parquet: str, checkpoint_root: str,
                           watermark: str = "45 minutes", trigger: str | None = "5 seconds",
                           decoded: bool = False) -> StreamingQuery:
    """Update-mode ward energy kept as one current row per window in the
    Parquet folder (idempotent per-window files)."""
    ev = raw if decoded else decode(raw, SMART_METERS, require=EVENT_TIME)
    agg = windows.ward_energy(ev.withWatermark("timestamp", watermark))
    return (agg.writeStream.outputMode("update")
            .option("checkpointLocation", _ck(checkpoint_root, "ward_energy_upsert"))
            .trigger(**writers.trigger_args(trigger))
            .foreachBatch(writers.upsert_partitions(out_parquet, ["ward_id", "window_start"],
                                                    ["ward_id", "date"]))
            .start())


def stop_flushed(queries: list[StreamingQuery], flush: Flush, every: str = "15 minutes", delay: str = "45 minutes",
                 slide: str | None = None) -> None:
    """Stop running queries once what has arrived is processed and their open
    windows are emitted.  Queries without an event yet have none."""
    for q in queries:
        q.processAllAvailable()
    seen = [x for x in (last_event_micros(q, delay) for q in queries) if x is not None]
    if seen:
        flush.mark(max(seen), every, delay, slide)
        for q in queries:
            q.processAllAvailable()
    for q in queries:
        q.stop()


def ward_energy_once_job(raw: DataFrame, out: str, checkpoint_root: str, watermark: str = "45 minutes", every: str = "15 minutes",
                         trigger: str | None = "5 seconds", decoded: bool = False, query: str = "ward_energy") -> StreamingQuery:
    """Ward energy with one state for both outputs: every version of a window
    goes once into a table of keyed JSON records and once into a Parquet
    table by ward and date (``ward_energy_tables``), also when the
    job is killed between the two and restarted."""
    ev = raw if decoded else decode(raw, SMART_METERS, require=EVENT_TIME)
    agg = windows.ward_energy(ev.withWatermark("timestamp", watermark), every=every)
    records, versions = ward_energy_tables(raw.sparkSession, out)
    return (agg.writeStream.outputMode("update").option("checkpointLocation", _ck(checkpoint_root, "ward_energy_once"))
            .trigger(**writers.trigger_args(trigger))
            .foreachBatch(into_tables(query, {
                "records": (records, lambda b, i: writers.keyed_json(b, "ward_id").withColumn("batch_id", F.lit(i).cast("long"))),
                "versions": (versions, lambda b, i: b.withColumn("batch_id", F.lit(i).cast("long")))}))
            .start())


def ward_energy_tables(spark: SparkSession, out: str) -> tuple[CommittedTable, CommittedTable]:
    """The tables (keyed JSON records, versions) of ``ward_energy_once_job``."""
    version = T.StructType.fromDDL("ward_id string, window_start timestamp, window_end timestamp, total_kwh_consumed double, "
                                   "avg_power_factor double, peak_voltage double, date date, batch_id long")
    return (CommittedTable(spark, f"{out}/records", T.StructType.fromDDL("key string, value string, batch_id long"), fmt="json"),
            CommittedTable(spark, f"{out}/versions", version, ["ward_id", "date"]))


# ------------------------------------------------------------------ health advisory (E1)
def advisory_stream(spark: SparkSession, raw: DataFrame, profile: DataFrame, threshold: float = 150.0,
                    watermark: str = "10 minutes", decoded: bool = False) -> DataFrame:
    """Air-quality stream -> 10-min average AQI per zone -> left join with the
    zone profile -> above threshold, with advisory level and text."""
    ev = raw if decoded else decode(raw, AIR_QUALITY, require=EVENT_TIME)
    avg = windows.zone_aqi(ev.withWatermark("timestamp", watermark))
    j = enrich.enrich(avg, profile.drop("zone_id"), "zone", "left", max_broadcast_rows=100_000)
    j = j.filter(F.col("rolling_avg_aqi") > threshold).withColumn("zone_name", F.coalesce("zone_name", "zone"))
    lvl = advisory_level("rolling_avg_aqi")
    return j.select("zone", "zone_name", "window_start", "window_end", "rolling_avg_aqi", "population",
                    "num_schools", "num_hospitals", "sensor_readings", lvl.alias("advisory_level"),
                    advisory_text("zone_name", lvl, "rolling_avg_aqi", "num_schools", "num_hospitals",
                                  "population").alias("advisory_text"),
                    F.current_timestamp().alias("emitted_at"))


def advisory_job(spark: SparkSession, raw: DataFrame, profile: DataFrame, out_json: str | None,
                 checkpoint_root: str, trigger: str | None = "5 seconds", kafka: dict | None = None,
                 **kw) -> StreamingQuery:
    adv = advisory_stream(spark, raw, profile, **kw)
    return writers.start_keyed_json(adv, "zone", _ck(checkpoint_root, "health_advisory"), "update",
                                    trigger, out_json, kafka)


# ------------------------------------------------------------------ bus enrichment
def enrichment_job(raw: DataFrame, routes: DataFrame, out_json: str | None, unmatched_json: str | None,
                   checkpoint_root: str, trigger: str | None = "5 seconds", kafka: dict | None = None,
                   decoded: bool = False) -> list[StreamingQuery]:
    """GPS stream joined to the route table (stream-static, broadcast after a
    size check); matches go to the enriched topic keyed by route, the rest
    to an unmatched output.  Of several dimension rows of a route the last
    wins.  Joined / unmatched counts are observed metrics."""
    ev = raw if decoded else decode(raw, BUS_GPS, require=EVENT_TIME)
    d = enrich.bounded_broadcast(enrich.last_row_wins(routes, ["route_id"]))
    flagged = ev.join(d.withColumn("__hit", F.lit(True)), "route_id", "left")
    flagged = flagged.observe("enrichment", F.count_if(F.col("__hit").isNotNull()).alias("joined"),
                              F.count_if(F.col("__hit").isNull()).alias("no_match"))
    hit = flagged.filter(F.col("__hit").isNotNull()).drop("__hit")
    miss = flagged.filter(F.col("__hit").isNull()).select(*ev.columns)
    qs = [writers.start_keyed_json(hit, "route_id", _ck(checkpoint_root, "bus_enriched"), "append",
                                   trigger, out_json, kafka)]
    if unmatched_json is not None:
        qs.append(writers.start_keyed_json(miss, "route_id", _ck(checkpoint_root, "bus_unmatched"), "append",
                                           trigger, unmatched_json))
    return qs


# ------------------------------------------------------------------ dead-letter validator
def dlq_job(raw: DataFrame, dlq_json: str | None, report_path: str, checkpoint_root: str,
            trigger: str | None = "5 seconds", kafka: dict | None = None,
            topic_names: dict[str, str] | None = None, every: str | None = None,
            watermark: str = "30 seconds") -> list[StreamingQuery]:
    """Validate a multi-topic envelope stream; invalid messages go to the
    dead-letter output keyed by original topic.  A report is kept current
    under ``report_path`` (``latest_report``): errors by topic and type, and
    per topic and in total how many messages were valid.  Its state is a row
    per topic and error type, whatever the messages hold.  With ``every`` (a
    duration) a report is also made for each window of that length
    (``window_reports``), when the watermark over the messages' times has
    passed its end."""
    from ..sources.streams import short_topic
    msgs = raw.withColumn("topic", short_topic("topic"))
    chk = quality.validate_payloads(msgs, "topic", "value", topics=topic_names)
    env = quality.dlq_envelope(chk, "topic", F.col("value").cast("string"))
    qs = [writers.start_keyed_json(env, "original_topic", _ck(checkpoint_root, "dlq"), "append",
                                   trigger, dlq_json, kafka)]
    dist = (chk.select("topic", F.explode(quality.counted_as()).alias("error"))
            .groupBy("topic", "error").agg(F.count(F.lit(1)).alias("count")))
    topics = sorted(topic_names or quality.RULES)

    def write_report(batch: DataFrame, batch_id: int) -> None:
        batch = batch.cache()
        try:
            totals = quality.report_totals(batch.groupBy("topic").agg(
                F.sum(F.when(F.col("error") == quality.VALID, F.col("count")).otherwise(0)).alias("valid"),
                F.sum(F.when(F.col("error") == quality.DEAD, F.col("count")).otherwise(0)).alias("dlq")), topics)
            folder = f"{report_path}/batch={batch_id:012d}"
            totals.coalesce(1).write.mode("overwrite").parquet(f"{folder}/totals")
            (batch.where(~F.col("error").isin(quality.VALID, quality.DEAD)).coalesce(1)
             .write.mode("overwrite").parquet(f"{folder}/errors"))            # last: its mark makes the report current
            writers.drop_old(batch.sparkSession, report_path, keep=3)
        finally:
            batch.unpersist()

    qs.append(dist.writeStream.outputMode("complete")
              .option("checkpointLocation", _ck(checkpoint_root, "dlq_report"))
              .trigger(**writers.trigger_args(trigger)).foreachBatch(write_report).start())
    if every is not None:
        timed = quality.validate_payloads(msgs.withWatermark("timestamp", watermark), "topic", "value", topics=topic_names)
        counts = quality.windowed_counts(timed, "timestamp", every)
        tables = window_reports(raw.sparkSession, report_path)
        qs.append(counts.writeStream.outputMode("append").option("checkpointLocation", _ck(checkpoint_root, "dlq_windows"))
                  .trigger(**writers.trigger_args(trigger))
                  .foreachBatch(into_tables("windows", {
                      "totals": (tables[0], lambda b, i: quality.windowed_report(b, topics)),
                      "errors": (tables[1], lambda b, i: quality.windowed_errors(b))}))
                  .start())
    return qs


def window_reports(spark: SparkSession, report_path: str) -> tuple[CommittedTable, CommittedTable]:
    """The tables (totals, errors) of the reports per window."""
    window = "window_start timestamp, window_end timestamp, topic string"
    kinds = {"totals": f"{window}, total long, valid long, dlq long, dlq_rate_pct double", "errors": f"{window}, error string, count long"}
    return tuple(CommittedTable(spark, f"{report_path}-windows/{k}", T.StructType.fromDDL(v)) for k, v in kinds.items())


def latest_report(spark: SparkSession, report_path: str) -> tuple[DataFrame, DataFrame]:
    """(errors, totals) of the newest complete report."""
    done = [f for f in writers.children(spark, report_path) if writers.path_exists(spark, f"{f}/errors/_SUCCESS")]
    if not done:
        raise FileNotFoundError(f"no report under {report_path}")
    return spark.read.parquet(f"{done[-1]}/errors"), spark.read.parquet(f"{done[-1]}/totals")


# ------------------------------------------------------------------ incidents (E3)
def incidents_streams(aq: DataFrame, traffic: DataFrame, bus: DataFrame, lateness: str = LATENESS,
                      aqi_above: int = 300, cooldown: str = "120 seconds", wait_above: float = 180,
                      n: int = 3, within: str = "300 seconds", distance_m: float = 200.0,
                      gap: str = "60 seconds", duration: str = "300 seconds") -> dict[str, DataFrame]:
    """Three decoded streams (with a long ``event_id`` that orders events of
    equal time) -> the three stateful detectors, each already in the common
    incident shape (``detect.INCIDENT_COLUMNS``; missing columns NULL): three
    queries writing to one incident output.  Bunching runs on chained keyed
    states, which need RocksDB as state store (``incidents_job`` sets it)."""
    a = detect.aqi_incident(stateful.cooldown_alerts_stream(
        aq.withWatermark("timestamp", lateness), "sensor_id", "timestamp", F.col("aqi") > aqi_above, cooldown),
        aqi_above)
    g = detect.gridlock_incident(stateful.consecutive_breach_stream(
        traffic.withWatermark("timestamp", lateness), "junction_id", "timestamp", "avg_wait_sec", wait_above,
        n, within))
    b = detect.bunching_incident(bunching_chained(
        bus.withWatermark("timestamp", lateness), max_distance_m=distance_m, max_gap=gap, duration=duration))
    return {t: detect.incident_shape(df) for t, df in (("AQI_EMERGENCY", a), ("TRAFFIC_GRIDLOCK", g), ("BUS_BUNCHING", b))}


def _ordered(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Decoded messages with an ``event_id`` from the envelope: the offset (the
    messages of a key share a partition), or where the source has none, a hash
    of the message."""
    own = raw.withColumn("event_id", F.coalesce(F.col("offset"), F.xxhash64("value")))
    return decode(own, schema, keep=("event_id",), require=EVENT_TIME)


def incidents_job(raw_aq: DataFrame, raw_traffic: DataFrame, raw_bus: DataFrame, out_json: str | None,
                  checkpoint_root: str, trigger: str | None = "5 seconds", kafka: dict | None = None,
                  **kw) -> list[StreamingQuery]:
    """The three detectors to one incident output keyed by incident type
    (one Kafka topic, or one JSON folder per type)."""
    key = "spark.sql.streaming.stateStore.providerClass"
    raw_aq.sparkSession.conf.set(key, RECOMMENDED_CONF[key])
    streams = incidents_streams(_ordered(raw_aq, AIR_QUALITY), _ordered(raw_traffic, TRAFFIC_SIGNALS),
                                _ordered(raw_bus, BUS_GPS), **kw)
    return [writers.start_keyed_json(df, "incident_type", _ck(checkpoint_root, f"incidents_{t.lower()}"),
                                     "append", trigger, None if out_json is None else f"{out_json}/{t}", kafka)
            for t, df in streams.items()]


# ------------------------------------------------------------------ AQI history archive
def aqi_history_job(raw: DataFrame, out_parquet: str, checkpoint_root: str,
                    trigger: str | None = "5 seconds", decoded: bool = False) -> StreamingQuery:
    """Decoded air-quality readings appended to Parquet partitioned by zone
    and date (the archive later reports and re-runs read)."""
    from ..operators.reports import aqi_history
    ev = raw if decoded else decode(raw, AIR_QUALITY, require=EVENT_TIME)
    return writers.start_parquet(aqi_history(ev), out_parquet, _ck(checkpoint_root, "aqi_history"),
                                 ["zone", "date"], trigger)


def run_until_stopped(spark: SparkSession) -> None:
    """Block while any query runs; a failed query's error is raised at once
    (the caller's supervisor restarts the job, which resumes from the
    checkpoints).  Queries that finish normally (``available_now``) do not
    end the others."""
    while spark.streams.active:
        spark.streams.awaitAnyTermination()  # raises if the query failed
        spark.streams.resetTerminated()


# ------------------------------------------------------------------ independent consumers (T13)
def independent_consumers(fast: DataFrame, slow: DataFrame, fast_out: str, slow_out: str,
                          checkpoint_root: str, trigger: str | None = None) -> list[StreamingQuery]:
    """Two queries on one source, each with its own checkpoint (its own
    offsets): the slow one (its source built with a small
    ``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``) falls behind without
    holding the fast one back."""
    q1 = fast.writeStream.format("parquet").option("checkpointLocation", _ck(checkpoint_root, "fast")) \
        .trigger(**writers.trigger_args(trigger)).start(fast_out)
    q2 = slow.writeStream.format("parquet").option("checkpointLocation", _ck(checkpoint_root, "slow")) \
        .trigger(**writers.trigger_args(trigger)).start(slow_out)
    return [q1, q2]
