"""Registered queries that run as Structured Streaming jobs.

Each reads a generated table as a file stream, applies the streaming form
of an operator (watermark, windowed aggregate in update mode, stream-static
join, stateful detector), drains the source with an ``availableNow``
trigger into a sink under the shared checkpoint folder, and returns what
the sink holds (update-mode versions collapsed to the newest).  Stream and
batch answers agree on in-order input, so the batch oracles apply.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import fixed, py_round
from ..operators import enrich, quality, windows
from ..operators.reports import aqi_history
from ..session import RECOMMENDED_CONF, parallelism, prepare, scratch_path
from ..sinks.committed import CommittedTable, into_tables
from ..sinks.writers import path_exists, start_parquet, upsert_partitions, versioned_append
from ..sources.streams import Flush, Replay, event_time, last_event_micros, table_stream
from ..streaming import jobs, stateful
from ..streaming.bunching import bunching_chained
from ..streaming.incremental import WeeklyReport
from . import catalog as C
from . import mapping as M


@contextmanager
def state_partitions(spark: SparkSession):
    """Start queries with one state partition per task slot (a query's
    state partitioning is fixed at its first start) and with state in RocksDB
    (which chained keyed state needs), then restore."""
    keys = {"spark.sql.shuffle.partitions": str(parallelism(spark)),
            "spark.sql.streaming.stateStore.providerClass": RECOMMENDED_CONF["spark.sql.streaming.stateStore.providerClass"]}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _drain(spark: SparkSession, df: DataFrame, checkpoint: str, mode: str, sink, feed: Iterable, flush=None) -> int:
    """Run a streaming DataFrame over all that is there (once per step of
    ``feed``, state carried by the checkpoint); the number of input rows.
    ``flush``: (Flush, window length, watermark delay): afterwards the windows still
    open are emitted."""
    rows, seen = 0, None

    def run():
        with state_partitions(spark):
            q = (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
                 .trigger(availableNow=True).foreachBatch(sink).start())
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return q

    for _ in feed:
        q = run()
        rows += sum(p.numInputRows for p in q.recentProgress)
        if flush:
            seen = max(filter(None, [seen, last_event_micros(q, flush[2])]), default=None)
    if flush and seen is not None:
        flush[0].mark(seen, *flush[1:])
        run()
    return rows


def run_to_table(spark: SparkSession, df: DataFrame, name: str, mode: str = "append",
                 keys: Sequence[str] | None = None, feed: Iterable = (0,), flush=None) -> DataFrame:
    """Drain a streaming DataFrame into Parquet (versioned by micro-batch)
    and read it back; update-mode results are collapsed per ``keys``.  Only a
    source without rows may leave no table; a table that cannot be read is an
    error."""
    out, ck = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    rows = _drain(spark, df, ck, mode, versioned_append(out), feed, flush)
    if not rows and not path_exists(spark, out):
        return spark.createDataFrame([], df.schema)
    res = spark.read.parquet(out)
    if keys:
        res = windows.latest_version(res, list(keys), "batch_id")
    return res.drop("batch_id")


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    prepare(spark)
    return event_time(table_stream(spark, sf, "events"), "ts")


#: files of a table replayed in one micro-batch
REPLAY_FILES = 64


def _events_replay(spark: SparkSession, sf: str, order: str = "ts", least: int = 1) -> tuple[DataFrame, Iterable]:
    """The events in event-time order (or in that of another column), and the
    steps that feed them, at least so many."""
    prepare(spark)
    r = Replay(spark, sf, "events", order, REPLAY_FILES, least=least)
    return event_time(r.stream, "ts"), r.feed()


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def stream_ward_energy(spark, sf):
    events, feed = _events_replay(spark, sf)
    ev = M.smart_meters(events).withWatermark("timestamp", "45 minutes")
    agg = windows.ward_energy(ev)
    res = run_to_table(spark, agg, "stream_ward_energy", "update", ["ward_id", "window_start"], feed=feed)
    return _ntz(res, "window_start", "window_end").select(*C.ward_energy_15m(spark, sf).columns)


def stream_zone_advisory(spark, sf):
    """Advisories from window averages kept in update mode: versions are
    collapsed before the threshold, so a window whose average has fallen
    below it since is not reported."""
    events, feed = _events_replay(spark, sf)
    aq = M.air_quality(events).withWatermark("timestamp", "10 minutes")
    res = run_to_table(spark, windows.zone_aqi(aq), "stream_zone_advisory", "update", ["zone", "window_start"], feed=feed)
    return C.advisories(_ntz(res, "window_start", "window_end"), M.zone_profile(spark))


def stream_rolling_avg_slide(spark, sf):
    """Sliding 10-minute AQI averages every 5 minutes on the stream (each
    reading updates two windows)."""
    events, feed = _events_replay(spark, sf)
    aq = M.air_quality(events).withWatermark("timestamp", "10 minutes")
    agg = windows.zone_aqi(aq, every="10 minutes", slide="5 minutes")
    res = run_to_table(spark, agg, "stream_rolling_avg_slide", "update", ["zone", "window_start"], feed=feed)
    return _ntz(res, "window_start", "window_end")


def stream_alerts_cooldown(spark, sf):
    events, feed = _events_replay(spark, sf)
    aq = M.air_quality(events).withWatermark("timestamp", "30 seconds")
    a = stateful.cooldown_alerts_stream(aq, "sensor_id", "timestamp", F.col("aqi") > C.AQI_ALERT_ABOVE,
                                        C.AQI_COOLDOWN, id_col="event_id")
    a = a.select(F.lit("AQI_EMERGENCY").alias("incident_type"), "sensor_id", "zone", "aqi", "pm25",
                 F.lit(C.AQI_ALERT_ABOVE).alias("threshold"),
                 F.format_string("HAZARDOUS AQI %d at sensor %s zone %s", "aqi", "sensor_id", "zone")
                 .alias("message"), F.col("timestamp").alias("event_time"), "event_id")
    return _ntz(run_to_table(spark, a, "stream_alerts_cooldown", feed=feed), "event_time")


def stream_alerts_consecutive(spark, sf):
    events, feed = _events_replay(spark, sf)
    tr = M.traffic_signals(events).withWatermark("timestamp", "30 seconds")
    g = stateful.consecutive_breach_stream(tr, "junction_id", "timestamp", "avg_wait_sec", C.WAIT_ABOVE,
                                           C.WAIT_N, C.WAIT_WITHIN, id_col="event_id")
    g = g.select(F.lit("TRAFFIC_GRIDLOCK").alias("incident_type"), "junction_id", "zone",
                 py_round("avg_last_n", 1).alias("avg_wait_sec"), "consecutive_readings",
                 F.format_string("GRIDLOCK at %s zone %s — avg wait %ss for %d cycles", "junction_id",
                                 "zone", fixed("avg_last_n", 0), "consecutive_readings").alias("message"),
                 F.col("timestamp").alias("event_time"), "event_id")
    return _ntz(run_to_table(spark, g, "stream_alerts_consecutive", feed=feed), "event_time")


def stream_enrich_lookup(spark, sf):
    prepare(spark)
    orders = table_stream(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice",
                                                      "o_orderdate")
    j = enrich.enrich(orders, M.customer_dim(spark, sf), "o_custkey", "inner")
    return run_to_table(spark, j, "stream_enrich_lookup")


def stream_enrich_unmatched(spark, sf):
    """Orders whose customer is not in the dimension, as a stream-static
    anti join (the unmatched output of the enrichment job)."""
    prepare(spark)
    orders = table_stream(spark, sf, "orders")
    return run_to_table(spark, enrich.unmatched(orders, M.customer_dim(spark, sf), "o_custkey"),
                        "stream_enrich_unmatched")


def stream_dlq_summary(spark, sf):
    """Running per-topic DLQ counters (complete mode: every trigger
    rewrites the totals; the last version is the answer)."""
    raw = M.raw_mixed(_events_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp_ntz")))
    chk = quality.validate_payloads(raw, "topic", "payload")
    summ = quality.dlq_summary(chk)
    return run_to_table(spark, summ, "stream_dlq_summary", "complete", ["topic"])


def stream_bunching_clock(spark, sf):
    """Clock-mode bunching alerts, a clock for each pair of buses: three keyed
    states in a row (bus, place, pair)."""
    events, feed = _events_replay(spark, sf)
    bus = M.bus_gps(events).withWatermark("timestamp", "30 minutes")
    b = bunching_chained(bus, max_distance_m=C.BUNCH_DISTANCE_M, max_gap=C.BUNCH_GAP, duration=C.BUNCH_MIN_DURATION)
    res = run_to_table(spark, b, "stream_bunching_clock", feed=feed).withColumn("distance_m", F.round("distance_m", 3))
    return _ntz(res, "event_time")


def stream_ward_energy_upsert(spark, sf):
    """Ward energy in update mode landed by the per-window upsert sink: the
    Parquet folder (partitioned by ward and date) holds one current row per
    window after every micro-batch -- read as is, no version collapse."""
    events, feed = _events_replay(spark, sf)
    ev = M.smart_meters(events).withWatermark("timestamp", "45 minutes")
    agg = windows.ward_energy(ev)
    out, ck = scratch_path(spark, "stream_ward_energy_upsert"), scratch_path(spark, "stream_ward_energy_upsert-ck")
    _drain(spark, agg, ck, "update", upsert_partitions(out, ["ward_id", "window_start"], ["ward_id", "date"]), feed)
    res = spark.read.parquet(out).drop("batch_id")
    return _ntz(res, "window_start", "window_end").select(*C.ward_energy_15m(spark, sf).columns)


def stream_aqi_history(spark, sf):
    """Air-quality readings archived by the append sink, partitioned by zone
    and date, then read back (partition columns from the folder names)."""
    aq = M.air_quality(_events_stream(spark, sf)).select("sensor_id", "zone", "pm25", "aqi", "timestamp",
                                                         "event_id")
    out, ck = scratch_path(spark, "stream_aqi_history"), scratch_path(spark, "stream_aqi_history-ck")
    q = start_parquet(aqi_history(aq), out, ck, ["zone", "date"], trigger="available_now")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    res = spark.read.parquet(out)
    return _ntz(res, "timestamp").select("sensor_id", "zone", "pm25", "aqi", "timestamp", "event_id", "date")


def stream_ward_energy_final(spark, sf):
    """Append mode: each window once, when the watermark has passed its end."""
    events, feed = _events_replay(spark, sf)
    ev = M.smart_meters(events).withWatermark("timestamp", "45 minutes")
    res = run_to_table(spark, windows.ward_energy(ev), "stream_ward_energy_final", "append", feed=feed)
    return _ntz(res, "window_start", "window_end").select(*C.ward_energy_15m(spark, sf).columns)


def _advisory_archive(spark, sf, flushed: bool) -> DataFrame:
    events, feed = _events_replay(spark, sf)
    aq, flush = M.air_quality(events), None
    if flushed:
        flush = (Flush(spark, scratch_path(spark, "advisory-flush")), "10 minutes", "10 minutes")
        timed = flush[0].watermark(aq, "10 minutes")
    else:
        timed = aq.withWatermark("timestamp", "10 minutes")
    adv = C.advisories(windows.zone_aqi(timed), M.zone_profile(spark)).withColumn("date", F.to_date("window_start"))
    table = CommittedTable(spark, scratch_path(spark, "stream_advisory_archive"), adv.schema, ["zone", "date"])
    _drain(spark, adv, scratch_path(spark, "stream_advisory_archive-ck"), "append",
           into_tables("advisories", {"archive": (table, lambda b, i: b)}), feed, flush)
    table.compact()
    return _ntz(table.read(), "window_start", "window_end")


def stream_advisory_archive(spark, sf):
    """Advisories of finished windows archived to Parquet by zone and date, one
    file per partition after compaction."""
    return _advisory_archive(spark, sf, False)


def stream_advisory_archive_flushed(spark, sf):
    """The archive of a stream that was stopped: its last windows included."""
    return _advisory_archive(spark, sf, True)


def stream_ward_energy_flushed(spark, sf):
    """Append mode with a flush at the end: every window once."""
    events, feed = _events_replay(spark, sf)
    flush = Flush(spark, scratch_path(spark, "ward-energy-flush"))
    agg = windows.ward_energy(flush.watermark(M.smart_meters(events), "45 minutes"))
    res = run_to_table(spark, agg, "stream_ward_energy_flushed", "append", feed=feed, flush=(flush, "15 minutes", "45 minutes"))
    return _ntz(res, "window_start", "window_end").select(*C.ward_energy_15m(spark, sf).columns)


def _report_windows(spark, sf, shape, name: str) -> DataFrame:
    events, feed = _events_replay(spark, sf)
    flush = Flush(spark, scratch_path(spark, f"{name}-flush"))
    raw = flush.watermark(M.raw_mixed(events), "30 seconds")
    counts = quality.windowed_counts(quality.validate_payloads(raw, "topic", "payload"), "timestamp", C.REPORT_EVERY)
    kind = shape(spark.createDataFrame([], counts.schema)).schema
    table = CommittedTable(spark, scratch_path(spark, name), kind)
    _drain(spark, counts, scratch_path(spark, f"{name}-ck"), "append", into_tables("report", {"report": (table, lambda b, i: shape(b))}),
           feed, (flush, C.REPORT_EVERY, "30 seconds"))
    return _ntz(table.read(), "window_start", "window_end")


def stream_dlq_report_5m(spark, sf):
    """The validator's report for each 5 minutes, written when the watermark
    has passed them; the last ones when the stream stops."""
    return _report_windows(spark, sf, lambda b: quality.windowed_report(b, C.REPORT_TOPICS), "stream_dlq_report_5m")


def stream_dlq_errors_5m(spark, sf):
    """Errors by topic and type for each 5 minutes, in the same way."""
    return _report_windows(spark, sf, quality.windowed_errors, "stream_dlq_errors_5m")


def stream_late_events(spark, sf):
    """The exact late cut on a stream: events arrive by id, in several
    micro-batches; those behind their topic's running watermark are the second output."""
    events, feed = _events_replay(spark, sf, "event_id", least=4)
    ev = events.select("event_id", "event_type", (F.col("ts") - F.make_dt_interval(
        hours=(F.col("event_id") % C.LATE_SHIFT_HOURS).cast("int"))).alias("event_time"))
    marked = stateful.mark_late_stream(ev, "event_type", "event_time", "event_id", C.LATENESS)
    kept, late = (CommittedTable(spark, scratch_path(spark, f"stream_{n}_events"), ev.schema) for n in ("kept", "late"))
    _drain(spark, marked, scratch_path(spark, "stream_late_events-ck"), "append", into_tables("cut", {
        "kept": (kept, lambda b, i: b.where(~F.col("is_late")).select(*ev.columns)),
        "late": (late, lambda b, i: b.where("is_late").select(*ev.columns))}), feed)
    return _ntz(late.read(), "event_time")


def stream_ward_energy_two_sinks(spark, sf):
    """Ward energy from one state into two tables, each version once: keyed
    JSON records and Parquet by ward and date; the newest version of each window in both."""
    events, feed = _events_replay(spark, sf, least=2)
    out, root = scratch_path(spark, "ward-energy-once"), scratch_path(spark, "ward-energy-once-ck")
    for _ in feed:
        with state_partitions(spark):
            q = jobs.ward_energy_once_job(M.smart_meters(events), out, root, trigger="available_now", decoded=True)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    records, versions = jobs.ward_energy_tables(spark, out)
    kind = versions.schema
    back = records.read().select(F.from_json("value", kind).alias("v"), F.col("batch_id").alias("b")).select("v.*", "b").drop("batch_id").withColumnRenamed("b", "batch_id")
    newest = [windows.latest_version(d, ["ward_id", "window_start"], "batch_id").drop("batch_id").select(F.lit(n).alias("sink"), "*")
              for n, d in (("records", back), ("versions", versions.read()))]
    return _ntz(newest[0].unionByName(newest[1]), "window_start", "window_end")


def stream_weekly_ward_report(spark, sf):
    """The weekly report kept current from update-mode windows by signed
    differences, over several micro-batches."""
    events, feed = _events_replay(spark, sf, "event_id", least=3)
    agg = windows.ward_energy(M.smart_meters(events))
    report = WeeklyReport(spark, scratch_path(spark, "weekly"))
    _drain(spark, agg, scratch_path(spark, "weekly-ck"), "update", report.write, feed)
    report.fold()
    return _ntz(report.read(), "week_start")


STREAM_QUERIES = {
    "stream_dlq_report_5m": stream_dlq_report_5m,
    "stream_dlq_errors_5m": stream_dlq_errors_5m,
    "stream_ward_energy_flushed": stream_ward_energy_flushed,
    "stream_late_events": stream_late_events,
    "stream_ward_energy_two_sinks": stream_ward_energy_two_sinks,
    "stream_weekly_ward_report": stream_weekly_ward_report,
    "stream_advisory_archive_flushed": stream_advisory_archive_flushed,
    "stream_ward_energy_final": stream_ward_energy_final,
    "stream_advisory_archive": stream_advisory_archive,
    "stream_ward_energy_upsert": stream_ward_energy_upsert,
    "stream_aqi_history": stream_aqi_history,
    "stream_dlq_summary": stream_dlq_summary,
    "stream_bunching_clock": stream_bunching_clock,
    "stream_ward_energy": stream_ward_energy,
    "stream_zone_advisory": stream_zone_advisory,
    "stream_rolling_avg_slide": stream_rolling_avg_slide,
    "stream_alerts_cooldown": stream_alerts_cooldown,
    "stream_alerts_consecutive": stream_alerts_consecutive,
    "stream_enrich_lookup": stream_enrich_lookup,
    "stream_enrich_unmatched": stream_enrich_unmatched,
}
