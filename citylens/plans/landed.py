"""Registered queries that run whole jobs and read back what their sinks hold.

The events table is archived as topics first (folders of JSON lines, see
``sources.read_topic_files``), in slices of event time; the jobs read these
through the message envelope and decode them as they would a broker's
messages.  Every query goes through a job runner of ``streaming.jobs``, so
its checkpoints, sinks, triggers and shutdown are what runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import detect, windows
from ..operators.reports import export
from ..schemas import BUS_GPS
from ..session import prepare, scratch_path
from ..sinks.writers import path_exists
from ..sources import dims
from ..sources.streams import Flush, Replay, fan_in, read_topic_files
from ..streaming import jobs
from ..streaming.metrics import ProgressRecorder
from . import catalog as C
from . import mapping as M
from .streamed import state_partitions

RECORD = "key string, value string"


def _iso(col: str = "timestamp"):
    """Event time as messages carry it (microseconds, UTC)."""
    return F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def as_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON texts, the event time in ISO form."""
    cols = [_iso().alias("timestamp") if c == "timestamp" else F.col(c) for c in df.columns if c not in ("event_id", "user_id")]
    return df.select(F.to_json(F.struct(*cols)).alias("value"), F.col("timestamp").alias("__ts"), F.col("event_id").alias("__id"))


class Topics:
    """The events table archived as topics, a slice of event time at a time.

    ``shapes``: topic -> function of the events that gives (value, __ts, __id)
    rows.  A file holds a range of event time in order, so the offsets of equal
    times follow the ids.  The folders exist before the first slice."""

    def __init__(self, spark: SparkSession, sf: str, shapes: Mapping[str, Callable[[DataFrame], DataFrame]], least: int = 1):
        prepare(spark)
        self.spark, self.shapes = spark, shapes
        self.replay = Replay(spark, sf, "events", least=least)
        self.folders = {t: scratch_path(spark, f"topic-{t}") for t in shapes}
        for f in self.folders.values():
            spark.createDataFrame([], "value string").write.mode("append").text(f)

    def read(self, topic: str, **kw) -> DataFrame:
        return read_topic_files(self.spark, self.folders[topic], f"city.{topic}", **kw)

    def feed(self) -> Iterator[int]:
        """Before each step the topics hold one slice more."""
        for i in range(self.replay.slices):
            ev = self.replay.slice(i)
            for topic, shape in self.shapes.items():
                (shape(ev).repartitionByRange("__ts").sortWithinPartitions("__ts", "__id").select("value")
                 .write.mode("append").text(self.folders[topic]))
            yield i


def _finish(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))


def _records(spark: SparkSession, path: str, kind: str, *extra: str) -> DataFrame:
    """The keyed JSON records of a sink, decoded; no folder: no record."""
    schema = ", ".join([RECORD, *extra])
    df = spark.read.schema(schema).json(path) if path_exists(spark, path) else spark.createDataFrame([], schema)
    return df.select("key", F.from_json("value", kind).alias("v"), *[e.split()[0] for e in extra]).select("key", "v.*", *[e.split()[0] for e in extra])


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# ---------------------------------------------------------------- dead letters
def stream_dlq_sink(spark, sf):
    """The validator job over four topics read as one stream: the dead letters
    as they lie in the keyed output."""
    def of(topic):
        return lambda ev: M.raw_mixed(ev).where(F.col("topic") == topic).select(
            F.col("payload").alias("value"), F.col("timestamp").alias("__ts"), F.col("event_id").alias("__id"))

    topics = Topics(spark, sf, {t: of(t) for t in sorted(set(M.TOPIC_OF_TYPE.values()))})
    out, report, ck = (scratch_path(spark, f"dlq-{n}") for n in ("letters", "report", "checkpoints"))
    raw = fan_in({f"city.{t}": topics.read(t) for t in topics.shapes})
    for _ in topics.feed():
        with state_partitions(spark):
            queries = jobs.dlq_job(raw, out, report, ck, trigger="available_now")
        _finish(queries)
    got = _records(spark, out, "original_topic string, error_reason string, all_errors array<string>, original_data string")
    return got.select("key", "original_topic", "error_reason", F.size("all_errors").alias("n_errors"),
                      F.array_join("all_errors", "|").alias("all_errors"), "original_data")


# ---------------------------------------------------------------- enrichment
ROUTES = 30


def bus_of_route(ev: DataFrame) -> DataFrame:
    """Bus positions whose route is a number below ``ROUTES`` (schedules exist
    for nations, so some routes have none)."""
    return M.bus_gps(ev, "user_id").withColumn("route_id", F.concat(F.lit("R-"), (F.col("user_id") % ROUTES).cast("string")))


def route_file(spark: SparkSession, sf: str) -> str:
    """A route schedule of several CSV files, made from the suppliers (route:
    nation) in order of their key: several rows per route."""
    rows = M.table(spark, sf, "supplier").select(
        F.concat(F.lit("R-"), F.col("s_nationkey").cast("string")).alias("route_id"), F.col("s_name").alias("route_name"),
        F.concat(F.lit("T-"), F.col("s_suppkey").cast("string")).alias("terminal"), F.lit("06:00").alias("scheduled_arrival_time"),
        (F.col("s_suppkey") % 60).cast("string").alias("frequency_min"), "s_suppkey")
    path = scratch_path(spark, "route_schedule")
    export(rows.repartitionByRange(3, "s_suppkey").sortWithinPartitions("s_suppkey").drop("s_suppkey"), path)
    return path


def _enrichment(spark, sf, unmatched: bool) -> tuple[str, str, ProgressRecorder, list[str]]:
    topics = Topics(spark, sf, {"bus_gps": lambda ev: as_messages(bus_of_route(ev))})
    routes = dims.route_schedule(spark, route_file(spark, sf), view=None)
    out, miss, ck = (scratch_path(spark, f"bus-{n}") for n in ("enriched", "unmatched", "checkpoints"))
    recorder, ran = ProgressRecorder(), []
    spark.streams.addListener(recorder)
    try:
        for _ in topics.feed():
            queries = jobs.enrichment_job(topics.read("bus_gps"), routes, out, miss if unmatched else None, ck, trigger="available_now")
            _finish(queries)
            recorder.wait(queries[0])
            ran.append(str(queries[0].runId))
    finally:
        spark.streams.removeListener(recorder)
    return out, miss, recorder, ran


def stream_bus_enriched(spark, sf):
    """The enrichment job: positions joined to the route schedule (the last row
    of the last file wins), and those without a route, as they lie in the two keyed outputs."""
    out, miss, *_ = _enrichment(spark, sf, True)
    kind = BUS_GPS.simpleString()[len("struct<"):-1].replace(":", " ") + ", route_name string, terminal string, frequency_min string"
    cols = ["key", "bus_id", "route_id", "lat", "lon", "timestamp", "route_name", "terminal", "frequency_min"]
    both = [_records(spark, p, kind).select(F.lit(n).alias("sink"), *cols) for n, p in (("enriched", out), ("unmatched", miss))]
    return _ntz(both[0].unionByName(both[1]), "timestamp")


def stream_enrichment_counters(spark, sf):
    """The counters of the enrichment job, from the progress of its batches:
    rows read, joined, without a match."""
    _, _, recorder, ran = _enrichment(spark, sf, False)
    seen = [m for run in ran for m in recorder.observed("enrichment", run)]
    rows = sum(recorder.rows_processed(run) for run in ran)
    counts = (rows, sum(m["joined"] for m in seen), sum(m["no_match"] for m in seen))
    return spark.createDataFrame([counts], "events long, joined long, no_match long")


def dimension_view(spark, sf):
    """Buses per terminal by SQL over the events and the CSV route schedule,
    both as views."""
    prepare(spark)
    dims.route_schedule(spark, route_file(spark, sf), view="route_schedule")
    bus_of_route(M.events(spark, sf)).createOrReplaceTempView("bus_positions")
    return spark.sql("""
        SELECT r.route_id, r.terminal, CAST(r.frequency_min AS INT) AS frequency_min, b.positions, b.buses
        FROM route_schedule r JOIN (SELECT route_id, COUNT(*) AS positions, COUNT(DISTINCT bus_id) AS buses
                                    FROM bus_positions GROUP BY route_id) b ON r.route_id = b.route_id""")


# ---------------------------------------------------------------- incidents
def stream_incident_sink(spark, sf):
    """The incident job over three topics: cooldown alerts, gridlocks and bunching
    (clock mode) as they lie in the keyed output; ``stamped``: the alert carries
    the time it was made, which is after the event."""
    topics = Topics(spark, sf, {"air_quality": lambda ev: as_messages(M.air_quality(ev)),
                                "traffic_signals": lambda ev: as_messages(M.traffic_signals(ev)),
                                "bus_gps": lambda ev: as_messages(M.bus_gps(ev))})
    out, ck = scratch_path(spark, "incidents"), scratch_path(spark, "incidents-ck")
    for _ in topics.feed():
        with state_partitions(spark):
            queries = jobs.incidents_job(
                topics.read("air_quality"), topics.read("traffic_signals"), topics.read("bus_gps"), out, ck, trigger="available_now",
                aqi_above=C.AQI_ALERT_ABOVE, cooldown=C.AQI_COOLDOWN, wait_above=C.WAIT_ABOVE, n=C.WAIT_N, within=C.WAIT_WITHIN,
                distance_m=C.BUNCH_DISTANCE_M, gap=C.BUNCH_GAP, duration=C.BUNCH_MIN_DURATION)
        _finish(queries)
    kind = ", ".join(f"{c} {t}" for c, t in detect.INCIDENT_TYPES.items())
    parts = [_records(spark, f"{out}/{t}", kind) for t in ("AQI_EMERGENCY", "TRAFFIC_GRIDLOCK", "BUS_BUNCHING")]
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return _ntz(every.withColumn("stamped", F.coalesce(F.col("alert_time") > F.col("event_time"), F.lit(False))).drop("alert_time"), "event_time")


# ---------------------------------------------------------------- lifecycle
def stream_ward_energy_live(spark, sf):
    """The ward energy job on a processing-time trigger while the topic grows,
    then stopped with its open windows emitted: keyed JSON (newest version of each
    window) and Parquet (finished windows), from two queries."""
    topics = Topics(spark, sf, {"smart_meters": lambda ev: as_messages(M.smart_meters(ev))}, least=2)
    parquet, records, ck, control = (scratch_path(spark, f"ward-live-{n}") for n in ("parquet", "json", "checkpoints", "flush"))
    flush, queries = Flush(spark, control), []
    try:
        for _ in topics.feed():
            if not queries:
                with state_partitions(spark):
                    queries = jobs.ward_energy_job(topics.read("smart_meters"), parquet, records, ck, trigger="1 second", flush=flush)
                    for q in queries:
                        q.processAllAvailable()
            for q in queries:
                q.processAllAvailable()
        jobs.stop_flushed(queries, flush)
    finally:
        for q in queries:
            q.stop()
    cols = C.ward_energy_15m(spark, sf).columns
    kind = "ward_id string, window_start timestamp, window_end timestamp, total_kwh_consumed double, avg_power_factor double, peak_voltage double, date date"
    newest = windows.latest_version(_records(spark, records, kind, "batch_id long").drop("key"), ["ward_id", "window_start"], "batch_id")
    done = spark.read.schema(kind).parquet(parquet)
    both = [d.select(F.lit(n).alias("sink"), *cols) for n, d in (("json", newest), ("parquet", done))]
    return _ntz(both[0].unionByName(both[1]), "window_start", "window_end")


def stream_independent_consumers(spark, sf):
    """Two consumers of one topic, one of them a file at a time: each ends up
    with every message."""
    topics = Topics(spark, sf, {"traffic_signals": lambda ev: as_messages(M.traffic_signals(ev))})
    outs, ck = [scratch_path(spark, f"consumer-{n}") for n in ("fast", "slow")], scratch_path(spark, "consumers-ck")
    for _ in topics.feed():
        _finish(jobs.independent_consumers(topics.read("traffic_signals"), topics.read("traffic_signals", max_files_per_trigger=1),
                                           *outs, ck, trigger="available_now"))
    got = None
    for name, path in zip(("fast", "slow"), outs, strict=True):
        one = spark.read.parquet(path).select(F.lit(name).alias("consumer"), F.get_json_object(F.col("value").cast("string"), "$.zone").alias("zone"))
        got = one if got is None else got.unionByName(one)
    return got.groupBy("consumer", "zone").agg(F.count("*").alias("messages"))


def report_exports(spark, sf):
    """The weekly report exported as CSV, JSON lines and Parquet (by ward), and
    read back from each."""
    report, got = C.weekly_ward_report(spark, sf), None
    for fmt in ("csv", "json", "parquet"):
        path = scratch_path(spark, f"export-{fmt}")
        export(report, path, fmt, ["ward_id"] if fmt == "parquet" else ())
        r = spark.read.schema(report.schema)
        back = r.option("header", "true").csv(path) if fmt == "csv" else r.format(fmt).load(path)
        one = back.select(F.lit(fmt).alias("format"), *report.columns)
        got = one if got is None else got.unionByName(one)
    return got


LANDED_QUERIES = {
    "stream_dlq_sink": stream_dlq_sink,
    "stream_bus_enriched": stream_bus_enriched,
    "stream_enrichment_counters": stream_enrichment_counters,
    "dimension_view": dimension_view,
    "stream_incident_sink": stream_incident_sink,
    "stream_ward_energy_live": stream_ward_energy_live,
    "stream_independent_consumers": stream_independent_consumers,
    "report_exports": report_exports,
}
