"""Windowed reports, flush, exact late cut, arrival order, committed tables,
incremental report, chained bunching: several micro-batches, restarts, replays."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from citylens.operators import detect, enrich, quality, sequence, windows
from citylens.session import scratch_path
from citylens.sinks import CommittedTable, into_tables, upsert_partitions
from citylens.sinks.writers import children
from citylens.sources import read_dimension, read_topic_files
from citylens.sources.streams import Flush, Replay, last_event_micros
from citylens.streaming import jobs, metrics, stateful
from citylens.streaming.bunching import bunching_chained
from citylens.streaming.incremental import WeeklyReport

T0 = dt.datetime(2024, 1, 1)
KV = "k string, v long"


def parts(spark, folder, schema, batches):
    """One Parquet file per batch, read one after the other."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches):
        add_part(spark, folder, schema, i, rows)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def add_part(spark, folder, schema, i, rows):
    tmp = f"{folder}-tmp-{i}"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(tmp)
    (name,) = [n for n in os.listdir(tmp) if n.endswith(".parquet")]
    os.replace(f"{tmp}/{name}", f"{folder}/part-{i:03d}.parquet")
    os.utime(f"{folder}/part-{i:03d}.parquet", (1_700_000_000 + i * 10,) * 2)


def drain(df, ck, mode, write):
    q = df.writeStream.outputMode(mode).option("checkpointLocation", ck).trigger(availableNow=True).foreachBatch(write).start()
    q.awaitTermination()
    assert q.exception() is None
    return q


# ---- committed tables -------------------------------------------------------------------------

def rows_of(df):
    return sorted(map(tuple, df.collect()))


def table(spark, path, **kw):
    return CommittedTable(spark, str(path), spark.createDataFrame([], KV).schema, ["k"], **kw)


def test_a_batch_is_in_the_table_once(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    a, b = (spark.createDataFrame(x, KV) for x in ([("x y", 1), ("b:%+", 2), (None, 9)], [("x y", 3)]))
    assert rows_of(t.read().where("false")) == [] and t.read().count() == 0
    assert t.append(a, "q", 0) and not t.append(a, "q", 0)
    assert t.append(b, "q", 1) and not t.append(b, "q", 0) and t.append(b, "other", 0)
    t._write(a, "half")                                  # written, not committed
    assert sorted(t.read().collect(), key=str) == sorted([*a.collect(), *b.collect(), *b.collect()], key=str)
    assert table(spark, tmp_path / "t").read().count() == 5


def test_compaction_swaps_the_file_set(spark, tmp_path):
    t = table(spark, tmp_path / "t")
    for i in range(6):
        t.append(spark.createDataFrame([("a b", i), ("é:%+", i), (f"only{i}", i)], KV), "q", i)
    before, want = t.files(), sorted(t.read().collect(), key=str)
    reader = t.read()
    assert t.compact() > 0
    after = t.files()
    assert len(before) == 18 and len(after) == 8         # one file for each of the two shared partitions
    assert sorted(t.read().collect(), key=str) == want == sorted(reader.collect(), key=str)      # an older reader too
    assert t.compact() == 0 and t.vacuum(keep=5) == 0
    for i in range(6, 9):
        t.append(spark.createDataFrame([("z", i)], KV), "q", i)
    assert t.vacuum(keep=2) == 12
    assert t.read().count() == len(want) + 3
    assert not t.append(spark.createDataFrame([("z", 1)], KV), "q", 8)


def test_bins_are_packed_and_full_files_stay(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path / "t")
    sizes = {"commit=c/k=a/1": 60, "commit=c/k=a/2": 40, "commit=d/k=a/3": 45, "commit=d/k=a/4": 10, "commit=d/k=a/5": 30, "commit=d/k=b/6": 5, "commit=d/k=c/7": 49, "commit=e/k=c/8": 49}
    monkeypatch.setattr(t, "files", lambda: sizes)
    got = [sorted(f[-1] for f in b) for b in t.plan(100)]
    assert got == [["2", "3", "4"], ["7", "8"]]          # 1 is large, 5 does not fit, 6 is alone


def test_ledger_is_folded(spark, tmp_path, monkeypatch):
    from citylens.sinks import committed

    monkeypatch.setattr(committed, "FOLD", 4)
    t = table(spark, tmp_path / "t")
    for i in range(11):
        t.append(spark.createDataFrame([("a", i)], KV), "q", i)
    assert len(os.listdir(tmp_path / "t" / "ledger")) <= 8          # entries and their checksums
    assert [r.v for r in t.read().orderBy("v").collect()] == list(range(11)) and t.done("q", 10) and not t.done("q", 11)


def test_two_writers_do_not_lose_a_commit(spark, tmp_path):
    one, two = table(spark, tmp_path / "t"), table(spark, tmp_path / "t")
    last = one._state()[0]
    assert one._publish(last + 1, {"add": {}, "drop": {}, "done": {"a": 1}})
    assert not two._publish(last + 1, {"add": {}, "drop": {}, "done": {"b": 1}})
    assert two.append(spark.createDataFrame([("a", 1)], KV), "b", 1) and one.done("a", 1) and one.done("b", 1)


def test_a_killed_job_leaves_each_version_once_in_both_sinks(spark, tmp_path):
    rows = [[(f"w{i % 3}", T0 + dt.timedelta(minutes=4 * (b * 10 + i)), float(i), 230.0, 0.9) for i in range(10)] for b in range(3)]
    schema = "ward_id string, timestamp timestamp, kwh_reading double, voltage double, power_factor double"
    st = parts(spark, f"{tmp_path}/in", schema, rows)
    agg = windows.ward_energy(st.withWatermark("timestamp", "45 minutes"))
    records, versions = jobs.ward_energy_tables(spark, f"{tmp_path}/out")
    ready = {"records": (records, lambda b, i: jobs.writers.keyed_json(b, "ward_id").withColumn("batch_id", F.lit(i).cast("long"))),
             "versions": (versions, lambda b, i: b.withColumn("batch_id", F.lit(i).cast("long")))}
    killed = []

    def dies(b, i):
        if i == 1 and not killed:
            killed.append(i)
            raise RuntimeError("killed between the two sinks")
        return ready["versions"][1](b, i)

    q = agg.writeStream.outputMode("update").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).foreachBatch(
        into_tables("q", {**ready, "versions": (versions, dies)})).start()
    with pytest.raises(Exception):
        q.awaitTermination()
    assert killed and records.read().where("batch_id = 1").count() > 0 and versions.read().where("batch_id = 1").count() == 0
    drain(agg, f"{tmp_path}/ck", "update", into_tables("q", ready))
    want = rows_of(windows.ward_energy(spark.createDataFrame([r for b in rows for r in b], schema)))
    assert rows_of(windows.latest_version(versions.read(), ["ward_id", "window_start"], "batch_id").select(
        "ward_id", "window_start", "window_end", "total_kwh_consumed", "avg_power_factor", "peak_voltage", "date")) == want
    keys = ["ward_id", "window_start", "batch_id"]
    back = records.read().select(F.from_json("value", versions.schema).alias("v"), "batch_id").select("v.ward_id", "v.window_start", "batch_id")
    for d in (versions.read(), back):
        assert d.count() == d.select(*keys).distinct().count()
    assert rows_of(back) == rows_of(versions.read().select(*keys))


def test_upsert_and_progress_leave_nothing_behind(spark, tmp_path):
    root = scratch_path(spark, "x").rsplit("/", 1)[0]

    def staged():
        return [c for c in children(spark, root) if "/upsert-" in c]

    before = staged()
    w = upsert_partitions(f"{tmp_path}/t", ["k"], ["k"])
    for i in range(10):
        w(spark.createDataFrame([("a", i), (None, i)], KV), i)
    assert sorted(spark.read.parquet(f"{tmp_path}/t").collect(), key=str) == sorted(spark.createDataFrame([(9, 9, "a"), (9, 9, None)], "v long, batch_id long, k string").collect(), key=str)
    assert staged() == before
    rec = metrics.ProgressRecorder(keep=3)
    for i in range(10):
        rec.onQueryProgress(type("E", (), {"progress": type("P", (), {"json": json.dumps({"numInputRows": 2, "batchId": i})})})())
    assert len(rec.events) == 3 and rec.rows_processed() == 20


# ---- flush ----------------------------------------------------------------------------------------

METER = "ward_id string, timestamp timestamp, kwh_reading double, voltage double, power_factor double"


def meter(minute, kwh=1.0, ward="w"):
    return (ward, T0 + dt.timedelta(minutes=minute), kwh, 230.0, 0.9)


def test_flush_emits_open_windows_once_and_goes_on_after_a_restart(spark, tmp_path):
    st = parts(spark, f"{tmp_path}/in", METER, [[meter(0), meter(16)], [meter(31), meter(44.9)]])
    flush, out = Flush(spark, f"{tmp_path}/flush"), []
    agg = windows.ward_energy(flush.watermark(st, "45 minutes"))

    def write(b, i):
        out.extend((r.window_start, r.total_kwh_consumed) for r in b.collect())

    q = drain(agg, f"{tmp_path}/ck", "append", write)
    assert out == [] and last_event_micros(q, "45 minutes") == int((T0 + dt.timedelta(minutes=44.9) - dt.datetime(1970, 1, 1)).total_seconds() * 1e6)
    flush.mark(last_event_micros(q, "45 minutes"), "15 minutes", "45 minutes")
    q = drain(agg, f"{tmp_path}/ck", "append", write)
    assert sorted(out) == [(T0, 1.0), (T0 + dt.timedelta(minutes=15), 1.0), (T0 + dt.timedelta(minutes=30), 2.0)]     # the marked row counts nowhere
    # after a restart: events of flushed windows are late, those of the next window are not
    add_part(spark, f"{tmp_path}/in", METER, 2, [meter(40, 7.0), meter(45, 5.0)])
    q = drain(agg, f"{tmp_path}/ck", "append", write)
    seen = last_event_micros(q, "45 minutes")
    flush.mark(seen, "15 minutes", "45 minutes")
    drain(agg, f"{tmp_path}/ck", "append", write)
    assert sorted(out)[3:] == [(T0 + dt.timedelta(minutes=45), 5.0)] and len(out) == 4


def test_flush_of_sliding_windows(spark, tmp_path):
    st = parts(spark, f"{tmp_path}/in", "zone string, aqi int, timestamp timestamp", [[("z", 10, T0 + dt.timedelta(minutes=m)) for m in (1, 6, 14)]])
    flush, out = Flush(spark, f"{tmp_path}/flush"), []
    agg = windows.zone_aqi(flush.watermark(st, "10 minutes"), every="10 minutes", slide="5 minutes")
    write = lambda b, i: out.extend((r.window_start, r.sensor_readings) for r in b.collect())
    q = drain(agg, f"{tmp_path}/ck", "append", write)
    flush.mark(last_event_micros(q, "10 minutes"), "10 minutes", "10 minutes", "5 minutes")
    drain(agg, f"{tmp_path}/ck", "append", write)
    want = windows.zone_aqi(spark.read.parquet(f"{tmp_path}/in"), every="10 minutes", slide="5 minutes").collect()
    assert sorted(out) == sorted((r.window_start, r.sensor_readings) for r in want)


def test_ward_energy_job_stopped_with_flush(spark, tmp_path):
    os.makedirs(f"{tmp_path}/src")
    with open(f"{tmp_path}/src/a.json", "w") as f:
        for m in (0, 5, 20):
            f.write(json.dumps({"meter_id": "M", "ward_id": "W", "kwh_reading": 1.5, "voltage": 230.0, "power_factor": 0.9,
                                "timestamp": f"2024-01-01T00:{m:02d}:00.000+00:00"}) + "\n")
    flush = Flush(spark, f"{tmp_path}/flush")
    qs = jobs.ward_energy_job(read_topic_files(spark, f"{tmp_path}/src", "smart_meters"), f"{tmp_path}/pq", None, f"{tmp_path}/ck", trigger=None, flush=flush)
    jobs.stop_flushed(qs, flush)
    assert sorted((r.window_start, r.total_kwh_consumed) for r in spark.read.parquet(f"{tmp_path}/pq").collect()) == [
        (T0, 3.0), (T0 + dt.timedelta(minutes=15), 1.5)]


# ---- windowed report --------------------------------------------------------------------------------

def test_report_per_window(spark, tmp_path):
    rows = [("air_quality", 1, '{"aqi": 10}'), ("air_quality", 4.9, '{"aqi": 900, "pm25": -1}'), ("air_quality", 5, "{bad"),
            ("bus_gps", 5, '{"lat": 13.0, "lon": 77.6}'), ("unheard", 1, "{}")]
    df = spark.createDataFrame([(t, T0 + dt.timedelta(minutes=m), v) for t, m, v in rows], "topic string, timestamp timestamp, payload string")
    counts = quality.windowed_counts(quality.validate_payloads(df, "topic", "payload"))
    got = {((r.window_start - T0).seconds // 60, r.topic): (r.total, r.valid, r.dlq, r.dlq_rate_pct)
           for r in quality.windowed_report(counts, ["air_quality", "bus_gps", "parking"]).collect()}
    assert got == {(0, "air_quality"): (2, 1, 1, 50.0), (0, "bus_gps"): (0, 0, 0, None), (0, "parking"): (0, 0, 0, None),
                   (0, "unheard"): (1, 0, 1, 100.0), (0, "TOTAL"): (3, 1, 2, 66.7),
                   (5, "air_quality"): (1, 0, 1, 100.0), (5, "bus_gps"): (1, 1, 0, 0.0), (5, "parking"): (0, 0, 0, None), (5, "TOTAL"): (2, 1, 1, 50.0)}
    errors = {((r.window_start - T0).seconds // 60, r.topic, r.error): r["count"] for r in quality.windowed_errors(counts).collect()}
    assert errors == {(0, "air_quality", "aqi_out_of_range"): 1, (0, "air_quality", "negative_pm25"): 1, (0, "unheard", "unknown_topic"): 1,
                      (5, "air_quality", "json_parse_error"): 1}


def test_dlq_job_reports_finished_windows(spark, tmp_path):
    schema = "value binary, topic string, timestamp timestamp"

    def msg(minute, body):
        return (bytearray(body.encode()), "city.air_quality", T0 + dt.timedelta(minutes=minute))

    st = parts(spark, f"{tmp_path}/in", schema, [[msg(0, '{"aqi": 1}'), msg(6, '{"aqi": 2}')], [msg(12, "{")], [msg(1, '{"aqi": 3}')]])
    qs = jobs.dlq_job(st, f"{tmp_path}/dlq", f"{tmp_path}/report", f"{tmp_path}/ck", trigger="available_now", every="5 minutes")
    for q in qs:
        q.awaitTermination()
        assert q.exception() is None
    totals, errors = jobs.window_reports(spark, f"{tmp_path}/report")
    got = {((r.window_start - T0).seconds // 60, r.topic): (r.valid, r.dlq) for r in totals.read().collect() if r.topic in ("TOTAL", "bus_gps")}
    # minute 1 came after its window was reported; minute 12's window is still open
    assert got == {(0, "TOTAL"): (1, 0), (0, "bus_gps"): (0, 0), (5, "TOTAL"): (1, 0), (5, "bus_gps"): (0, 0)} and errors.read().count() == 0


# ---- exact late cut -----------------------------------------------------------------------------------

def test_late_cut_on_a_stream_is_the_batch_rule(spark, tmp_path):
    rnd = random.Random(2)
    schema = "id long, topic string, part int, ts timestamp"
    rows = [(i, rnd.choice("aab"), rnd.randrange(2), None if i % 41 == 0 else T0 + dt.timedelta(seconds=10 * i - 10 * rnd.choice([0, 0, 3, 4, 5, 9]))) for i in range(400)]
    batches = [rnd.sample(rows[b * 100:(b + 1) * 100], 100) for b in range(4)]           # in order between batches only
    st = parts(spark, f"{tmp_path}/in", schema, batches)
    out = stateful.mark_late_stream(st, ["topic", "part"], "ts", "id", "30 seconds")
    t = CommittedTable(spark, f"{tmp_path}/out", out.schema)
    drain(out, f"{tmp_path}/ck", "append", into_tables("q", {"all": (t, lambda b, i: b)}))
    want = detect.mark_late(spark.createDataFrame(rows, schema), ["topic", "part"], "ts", "id", "30 seconds")
    assert sorted(map(str, t.read().select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert 20 < t.read().where("is_late").count() < 200


# ---- arrival order ---------------------------------------------------------------------------------------

def test_the_last_row_of_the_last_file_wins(spark, tmp_path):
    os.makedirs(f"{tmp_path}/d")
    for name, tag, n in (("a.csv", "old", 3), ("b.csv", "new", 5000), ("c.csv", "c", 1)):
        with open(f"{tmp_path}/d/{name}", "w") as f:
            f.write("route_id,tag\n")
            f.writelines(f"R{i % 100 if name != 'c.csv' else 7},{tag}{i}\n" for i in range(n))
    schema = "route_id string, tag string"
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = {r.route_id: r.tag for r in enrich.last_row_wins(read_dimension(spark, f"{tmp_path}/d", schema), ["route_id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {f"R{i}": f"new{4900 + i}" for i in range(100)} | {"R7": "c0"}
    plain = spark.createDataFrame([("R1", "x"), ("R2", "y"), ("R1", "z")], schema)
    assert {r.route_id: r.tag for r in enrich.last_row_wins(plain, ["route_id"]).collect()} == {"R1": "z", "R2": "y"}


@pytest.mark.parametrize("stream", [False, True])
def test_lines_of_a_file_topic_have_positions(spark, tmp_path, stream):
    os.makedirs(f"{tmp_path}/t")
    for name, n in (("a", 3000), ("b", 10)):
        with open(f"{tmp_path}/t/{name}.json", "w") as f:
            f.writelines(f'{{"n": {i}, "f": "{name}"}}\n' for i in range(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = read_topic_files(spark, f"{tmp_path}/t", "x", stream=stream)
        if stream:
            df.drop("timestamp").writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start(f"{tmp_path}/o").awaitTermination()
            df = spark.read.parquet(f"{tmp_path}/o")
        rows = [(r.partition, r.offset, json.loads(bytes(r.value))) for r in df.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(rows) == 3010
    for name, n in (("a", 3000), ("b", 10)):
        own = sorted((p, o, v["n"]) for p, o, v in rows if v["f"] == name)
        assert len({p for p, _, _ in own}) == 1 and len({o for _, o, _ in own}) == n and [v for _, _, v in own] == list(range(n))


def test_replay_is_bounded_by_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id AS event_id", "timestamp_seconds((id * 37) % 1000) AS ts").repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    for order, n in (("ts", 4), ("event_id", 4)):
        r = Replay(spark, str(tmp_path), "events", order, max_rows=250)
        assert r.slices == n
        sizes, seen, top = [], 0, -1
        for _ in r.feed():
            now = spark.read.parquet(r.live)
            new = now.count() - seen
            sizes.append(new)
            seen += new
        assert sum(sizes) == 1000 and max(sizes) < 400 and top < 0
    assert Replay(spark, str(tmp_path), "events").slices == 1


# ---- positions, cooldown ------------------------------------------------------------------------------------

def test_keyed_position(spark):
    rnd = random.Random(4)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), rnd.choice([None, *range(40)]), i) for i in range(800)]
    got = sequence.keyed_position(spark.createDataFrame(rows, "k string, t int, id int"), ["k"], ["t", "id"], parts=7)
    by = {}
    for k, t, i in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2])):
        by.setdefault(k, []).append((t, i))
    assert sorted(map(str, ((r.k, r.t, r.id, r.position) for r in got.collect()))) == sorted(
        str((k, t, i, n)) for k, own in by.items() for n, (t, i) in enumerate(own, 1))
    assert got.where("false").count() == 0 and got.schema["position"].dataType.typeName() == "long"


@pytest.mark.parametrize("cool,chunk", [(60, 60.0), (60, 600.0), (600, None), (0, 1.0)])
def test_cooldown_over_many_chunks(spark, cool, chunk):
    rnd = random.Random(cool)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(6)}", rnd.randrange(20_000), rnd.randrange(10), i) for i in range(1500)]
    rows += [("gap", t, 9, 5000 + t) for t in (0, 59, 60, 119, 120, 9_000, 9_061, 500_000)] + [(None, 5, 9, 9001)]
    df = spark.createDataFrame([(k, T0 + dt.timedelta(seconds=t), v, i) for k, t, v, i in rows], "k string, ts timestamp, v int, event_id long")
    got = detect.cooldown_alerts(df, "k", "ts", F.col("v") > 3, cool, chunk_s=chunk)
    want, last = [], {}
    for k, t, v, i in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[1], r[3])):
        if v > 3 and (k not in last or t - last[k] >= cool):
            last[k] = t
            want.append(i)
    assert sorted(r.event_id for r in got.collect()) == sorted(want) and got.columns == df.columns


def test_incidents_drop_late_events_and_leave_no_checkpoint(spark):
    schema = "sensor_id string, junction_id string, bus_id string, route_id string, zone string, aqi int, pm25 double, avg_wait_sec int, lat double, lon double, timestamp timestamp, n long"
    rows = [("S", "J", f"B{i % 2}", "R", "Z", 400, 1.0, 200, 12.9, 77.6, T0 + dt.timedelta(seconds=s), i)
            for i, s in enumerate((0, 200, 400, 300, 650, 20, 700))]         # 300 and 20 are late
    df = spark.createDataFrame(rows, schema)
    root = spark.sparkContext.getCheckpointDir()
    before = [c for c in children(spark, root) if "/rdd-" in c]
    got = detect.incidents(df, df, df, "n")
    a = sorted((r.event_time - T0).seconds for r in got.where("incident_type = 'AQI_EMERGENCY'").collect())
    assert a == [0, 200, 400, 650]                      # 300 would not fire anyway, 20 is dropped
    assert [(r.event_time - T0).seconds for r in got.where("incident_type = 'TRAFFIC_GRIDLOCK'").collect()] == [700]
    assert [c for c in children(spark, root) if "/rdd-" in c] == before


# ---- incremental weekly report ---------------------------------------------------------------------------------

def test_weekly_report_follows_updates_and_ignores_replays(spark, tmp_path):
    schema = "ward_id string, window_start timestamp, window_end timestamp, total_kwh_consumed double, avg_power_factor double, peak_voltage double, date date"

    def version(ward, day, hour, kwh, peak):
        t = T0 + dt.timedelta(days=day, hours=hour)
        return (ward, t, t + dt.timedelta(minutes=15), kwh, 0.9, peak, t.date())

    batches = [[version("a", 0, 1, 1.1, 220.0), version("b", 0, 1, 2.0, 221.0), version(None, 1, 0, 4.0, 1.0)],
               [version("a", 0, 1, 3.3, 230.0), version("a", 7, 1, 5.5, 225.0), version(None, 1, 0, 4.5, 2.0)],
               [version("a", 0, 1, 3.3, 230.0), version("b", 0, 2, 0.7, 219.0)]]
    r, now = WeeklyReport(spark, f"{tmp_path}/w"), {}
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, schema)
        r.write(df, i)
        if i == 1:
            r.write(df, i)                              # replayed after both steps
        now.update({(x[0], x[1]): x for x in rows})
        current = spark.createDataFrame(list(now.values()), schema)
        want = current.groupBy(F.date_trunc("week", "window_start").alias("week_start"), "ward_id").agg(
            F.round(F.sum("total_kwh_consumed"), 2).alias("total_kwh"), F.max("peak_voltage").alias("peak_voltage"), F.count("*").alias("windows"))
        assert sorted(map(str, r.read().collect())) == sorted(map(str, want.collect()))
    # killed after the differences were committed, before the windows were brought up to date
    last = spark.createDataFrame([version("b", 0, 2, 1.7, 219.5)], schema)
    r.deltas.append(r.differences(last), r.query, 3)
    r.write(last, 3)
    r.write(spark.createDataFrame([version("b", 0, 2, 2.0, 219.5)], schema), 4)
    got = {(x.week_start, x.ward_id): (x.total_kwh, x.windows) for x in r.read().collect()}
    assert got[T0, "b"] == (4.0, 2)
    assert r.fold() > 0 and {(x.week_start, x.ward_id): (x.total_kwh, x.windows) for x in r.read().collect()} == got


# ---- chained bunching --------------------------------------------------------------------------------------------

@pytest.mark.parametrize("factor", [4.0, 1.0])
def test_chained_bunching_matches_the_model(spark, tmp_path, factor):
    from test_streaming import _bunch_model

    rnd = random.Random(11)
    rows = [(rnd.choice(["R1", "R2", "R1"]), f"B{rnd.randrange(5)}", i * 7 + rnd.randrange(5),
             round(12.9 + rnd.random() * 0.004, 6), round(77.6 + rnd.random() * 0.004, 6)) for i in range(600)]
    schema = "route_id string, bus_id string, timestamp timestamp, lat double, lon double, event_id long"
    full = [(r, b, T0 + dt.timedelta(seconds=t), la, lo, i) for i, (r, b, t, la, lo) in enumerate(rows)]
    order = sorted(full, key=lambda r: (r[2], r[5]))
    st = parts(spark, f"{tmp_path}/bus", schema, [order[b * 200:(b + 1) * 200] for b in range(3)] + [[("R9", None, T0 + dt.timedelta(hours=9), 1.0, 1.0, 9999), ("R9", "B", T0 + dt.timedelta(hours=9), None, 1.0, 9998)]])
    out = bunching_chained(st.withWatermark("timestamp", "10 minutes"), max_distance_m=200.0, max_gap=60, duration=120, cell_factor=factor)
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    assert q.exception() is None
    got = sorted((r.route_id, r.bus_1, r.bus_2, r.event_id) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert len(got) > 5 and got == _bunch_model(rows, 60, 120, 200.0)


# ---- many keys in few calls --------------------------------------------------------------------------------------

def test_detectors_take_all_keys_of_a_bucket_at_once(spark, tmp_path):
    from citylens.operators import detect
    from citylens.streaming import stateful

    rnd = random.Random(29)
    rows = sorted(((f"S{rnd.randrange(60)}", T0 + dt.timedelta(seconds=rnd.randrange(4000)), float(rnd.randrange(100)), i) for i in range(3000)),
                  key=lambda r: (r[1], r[3]))
    schema = "sensor string, timestamp timestamp, value double, event_id long"
    cuts = [rows[b * 600:(b + 1) * 600] for b in range(5)]
    every = spark.createDataFrame(rows, schema)
    high = F.col("value") > 40
    for name, stream, batch in [
            ("cool", lambda d: stateful.cooldown_alerts_stream(d, "sensor", "timestamp", high, 120, buckets=3),
             detect.cooldown_alerts(every, "sensor", "timestamp", high, 120)),
            ("run", lambda d: stateful.consecutive_breach_stream(d, "sensor", "timestamp", "value", 40, 3, 300, buckets=3),
             detect.consecutive_breach(every, "sensor", "timestamp", "value", 40, 3, 300, order=["event_id"]))]:
        st = parts(spark, f"{tmp_path}/{name}", schema, cuts).withWatermark("timestamp", "30 seconds")
        q = (stream(st).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/{name}-ck")
             .trigger(availableNow=True).start(f"{tmp_path}/{name}-out"))
        q.awaitTermination()
        assert q.exception() is None
        got = sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/{name}-out").collect())
        assert len(got) > 100 and got == sorted(r.event_id for r in batch.collect())


def test_rows_travel_between_bunching_states_by_group(spark):
    import pyarrow as pa

    from citylens.streaming.bunching import _packed

    rows = spark.range(2000, numPartitions=2).selectExpr("id", "cast(id as string) AS bus", "cast(id % 5 as int) AS __bucket")
    got = _packed(rows).collect()
    assert len(got) == 10 and sorted(x for r in got for x in pa.ipc.open_stream(r["pack"]).read_pandas()["id"]) == list(range(2000))
    assert all((pa.ipc.open_stream(r["pack"]).read_pandas()["id"] % 5 == r["__bucket"]).all() for r in got)
