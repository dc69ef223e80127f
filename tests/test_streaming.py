"""Streaming runners: several files -> several micro-batches; the stream's
answer must equal the batch operator's answer on the same decoded input."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from citylens.functions import decode
from citylens.operators import detect, windows
from citylens.plans import mapping as M
from citylens.schemas import AIR_QUALITY, BUS_GPS, SMART_METERS, TRAFFIC_SIGNALS
from citylens.sinks import upsert_partitions
from citylens.sources import read_topic_files
from citylens.streaming import jobs, metrics, stateful

SF = "/root/testdata/sf0.001"


def _write_topic(spark, df, folder, n_files=4):
    """Rows as JSON lines, split in time order over ``n_files`` files."""
    pdf = df.orderBy("timestamp", "event_id").toPandas() if "event_id" in df.columns else \
        df.orderBy("timestamp").toPandas()
    import json
    import os
    os.makedirs(folder, exist_ok=True)
    size = math.ceil(len(pdf) / n_files)
    for i in range(n_files):
        part = pdf.iloc[i * size:(i + 1) * size]
        with open(f"{folder}/part-{i:03d}.json", "w") as f:
            for rec in part.to_dict("records"):
                out = {}
                for k, v in rec.items():
                    if v is None or (isinstance(v, float) and math.isnan(v)):
                        continue
                    if hasattr(v, "isoformat"):
                        v = v.isoformat(timespec="microseconds") + "+00:00"
                    out[k] = v.item() if hasattr(v, "item") else v
                f.write(json.dumps(out) + "\n")
        os.utime(f"{folder}/part-{i:03d}.json", (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))


@pytest.fixture(scope="module")
def topics(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("topics")
    ev = M.events(spark, SF)
    _write_topic(spark, M.smart_meters(ev).drop("user_id"), f"{root}/smart_meters")
    _write_topic(spark, M.air_quality(ev).withColumn("pm10", F.col("pm25")).withColumn("no2", F.lit(1.0))
                 .drop("user_id"), f"{root}/air_quality")
    _write_topic(spark, M.traffic_signals(ev).drop("user_id"), f"{root}/traffic_signals")
    _write_topic(spark, M.bus_gps(ev).withColumn("speed_kmh", F.lit(30.0)), f"{root}/bus_gps")
    return str(root)


def _stream(spark, topics, name, schema=None):
    raw = read_topic_files(spark, f"{topics}/{name}", name, max_files_per_trigger=1)
    return raw


def _batch(spark, topics, name, schema):
    return decode(read_topic_files(spark, f"{topics}/{name}", name, stream=False), schema)


def _key(rows, cols):
    return sorted(tuple(r[c] for c in cols) for r in rows)


def test_ward_energy_job_two_sinks(spark, topics, tmp_path):
    raw = _stream(spark, topics, "smart_meters")
    qs = jobs.ward_energy_job(raw, f"{tmp_path}/pq", f"{tmp_path}/json", f"{tmp_path}/ck",
                              trigger="available_now")
    for q in qs:
        q.awaitTermination()
    assert all(q.exception() is None for q in qs)
    want = windows.ward_energy(_batch(spark, topics, "smart_meters", SMART_METERS))
    cols = ["ward_id", "window_start", "total_kwh_consumed", "avg_power_factor", "peak_voltage"]
    want_rows = _key(want.collect(), cols)
    # update-mode keyed JSON: newest version per window = the batch answer
    js = spark.read.json(f"{tmp_path}/json")
    dec = js.select("key", "batch_id", F.from_json("value", want.schema).alias("v")).select("batch_id", "v.*")
    got = windows.latest_version(dec, ["ward_id", "window_start"], "batch_id")
    assert _key(got.collect(), cols) == want_rows
    # append-mode Parquet: only finalised windows, each exactly once, partitioned by ward and date
    pq = spark.read.parquet(f"{tmp_path}/pq")
    got_pq = _key(pq.collect(), cols)
    assert len(got_pq) == len(set(got_pq)) and set(got_pq) <= set(want_rows)
    assert len(got_pq) >= len(want_rows) - 5
    assert set(pq.columns) >= {"ward_id", "date"}


def test_upsert_sink_keeps_one_row_per_window(spark, topics, tmp_path):
    raw = _stream(spark, topics, "smart_meters")
    q = jobs.ward_energy_upsert_job(raw, f"{tmp_path}/pq", f"{tmp_path}/ck", trigger="available_now")
    q.awaitTermination()
    want = windows.ward_energy(_batch(spark, topics, "smart_meters", SMART_METERS))
    got = spark.read.parquet(f"{tmp_path}/pq")
    cols = ["ward_id", "window_start", "total_kwh_consumed", "peak_voltage"]
    assert _key(got.collect(), cols) == _key(want.collect(), cols)


def test_upsert_partitions_keeps_new_rows_and_raises_on_read_errors(spark, tmp_path):
    w = upsert_partitions(f"{tmp_path}/t", ["k", "w"], ["k"])
    w(spark.createDataFrame([("a", 1, 10.0)], "k string, w int, v double"), 7)
    w(spark.createDataFrame([("a", 1, 12.0)], "k string, w int, v double"), 0)    # a new checkpoint counts from 0 again
    assert [r.v for r in spark.read.parquet(f"{tmp_path}/t").collect()] == [12.0]
    bad = tmp_path / "bad"
    (bad / "k=a").mkdir(parents=True)
    (bad / "k=a" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        upsert_partitions(str(bad), ["k", "w"], ["k"])(spark.createDataFrame([("a", 1, 1.0)], "k string, w int, v double"), 1)
    assert (bad / "k=a" / "part-0.parquet").read_bytes() == b"no parquet"


def test_streams_over_unordered_part_files_match_batch(spark, tmp_path, monkeypatch):
    """events as a folder of part files in no order, read in several batches."""
    import shutil

    from citylens.plans import catalog, streamed
    src = "/root/testdata/sf0.001"
    for t in ("orders", "customer", "nation", "region"):
        shutil.copy(f"{src}/{t}.parquet", f"{tmp_path}/{t}.parquet")
    (spark.read.parquet(f"{src}/events.parquet").withColumn("r", F.xxhash64("event_id"))
     .repartitionByRange(8, "r").drop("r").write.parquet(f"{tmp_path}/events.parquet"))
    monkeypatch.setattr(streamed, "REPLAY_FILES", 2)
    sf = str(tmp_path)
    for name in ("ward_energy", "zone_advisory", "rolling_avg_slide", "alerts_cooldown", "alerts_consecutive", "ward_energy_upsert", "dlq_summary"):
        batch = {"ward_energy": "ward_energy_15m", "ward_energy_upsert": "ward_energy_15m"}.get(name, name)
        want = catalog.QUERIES[batch](spark, src)
        got = streamed.STREAM_QUERIES[f"stream_{name}"](spark, sf).select(*want.columns)
        assert want.count() and sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name


def test_a_stream_that_cannot_read_its_table_is_an_error(spark, tmp_path):
    from citylens.plans import streamed
    (tmp_path / "events.parquet").mkdir()
    (tmp_path / "events.parquet" / "part-0.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        streamed.STREAM_QUERIES["stream_ward_energy"](spark, str(tmp_path))


def test_upsert_partitions_replay_is_idempotent(spark, tmp_path):
    w = upsert_partitions(f"{tmp_path}/t", ["k", "w"], ["k"])
    b1 = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 5.0)], "k string, w int, v double")
    b2 = spark.createDataFrame([("a", 1, 12.0), ("a", 2, 1.0)], "k string, w int, v double")
    w(b1, 0)
    w(b2, 1)
    w(b2, 1)  # replay after a failure
    got = sorted((r.k, r.w, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect())
    assert got == [("a", 1, 12.0), ("a", 2, 1.0), ("b", 1, 5.0)]


def test_advisory_job_matches_batch(spark, topics, tmp_path):
    raw = _stream(spark, topics, "air_quality")
    profile = M.zone_profile(spark)
    q = jobs.advisory_job(spark, raw, profile, f"{tmp_path}/adv", f"{tmp_path}/ck", trigger="available_now",
                          threshold=150.0)
    q.awaitTermination()
    assert q.exception() is None
    from citylens.plans.catalog import advisories
    want = advisories(windows.zone_aqi(_batch(spark, topics, "air_quality", AIR_QUALITY)), profile)
    js = spark.read.json(f"{tmp_path}/adv")
    dec = js.select("batch_id", F.from_json("value", "zone string, window_start timestamp, "
                                                     "rolling_avg_aqi double, advisory_level string").alias("v"))
    got = windows.latest_version(dec.select("batch_id", "v.*"), ["zone", "window_start"], "batch_id")
    cols = ["zone", "window_start", "rolling_avg_aqi", "advisory_level"]
    # update mode: a window that rose above the threshold is emitted (and stays emitted)
    assert set(_key(want.collect(), cols)) <= set(_key(got.collect(), cols))


def test_incidents_stream_cooldown_and_gridlock_match_batch(spark, topics, tmp_path):
    aq = decode(_stream(spark, topics, "air_quality"), AIR_QUALITY)
    tr = decode(_stream(spark, topics, "traffic_signals"), TRAFFIC_SIGNALS)
    bus = decode(_stream(spark, topics, "bus_gps"), BUS_GPS)
    streams = jobs.incidents_streams(aq.withColumn("event_id", F.lit(0).cast("long")),
                                tr.withColumn("event_id", F.lit(0).cast("long")),
                                bus.withColumn("event_id", F.lit(0).cast("long")), aqi_above=250, cooldown="2 days", wait_above=40,
                                within="3 days", distance_m=250.0, gap="30 minutes", duration="1 hour")
    for t, inc in streams.items():
        q = inc.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck/{t}") \
            .trigger(availableNow=True).start(f"{tmp_path}/inc/{t}")
        q.awaitTermination()
        assert q.exception() is None
    got = spark.read.parquet(*[f"{tmp_path}/inc/{t}" for t in ("AQI_EMERGENCY", "TRAFFIC_GRIDLOCK")])
    b_aq = _batch(spark, topics, "air_quality", AIR_QUALITY).withColumn("event_id", F.lit(0).cast("long"))
    want_a = detect.cooldown_alerts(b_aq.withColumn("rid", F.monotonically_increasing_id()), "sensor_id",
                                    "timestamp", F.col("aqi") > 250, "2 days", id_col="rid")
    got_a = got.filter("incident_type = 'AQI_EMERGENCY'")
    assert sorted((r.sensor_id, r.event_time) for r in got_a.collect()) == \
        sorted((r.sensor_id, r.timestamp) for r in want_a.collect())
    b_tr = _batch(spark, topics, "traffic_signals", TRAFFIC_SIGNALS).withColumn("rid", F.monotonically_increasing_id())
    want_g = detect.consecutive_breach(b_tr, "junction_id", "timestamp", "avg_wait_sec", 40, 3, "3 days",
                                       order=["rid"])
    got_g = got.filter("incident_type = 'TRAFFIC_GRIDLOCK'")
    assert sorted((r.junction_id, r.event_time) for r in got_g.collect()) == \
        sorted((r.junction_id, r.timestamp) for r in want_g.collect())


def test_enrichment_job_and_counters(spark, tmp_path):
    import json
    import os
    os.makedirs(f"{tmp_path}/gps")
    with open(f"{tmp_path}/routes.csv", "w") as f:
        f.write("route_id,route_name,terminal,scheduled_arrival_time,frequency_min\n"
                "R001,Old Line,T0,05:00,10\nR001,Harbour Line,T1,06:00,15\nR002,Local,T2,06:15,20\n")
    with open(f"{tmp_path}/gps/a.json", "w") as f:
        for i, r in enumerate(["R001", "R002", "R999", "R001"]):
            f.write(json.dumps({"bus_id": f"B{i}", "route_id": r, "lat": 12.9, "lon": 77.6, "speed_kmh": 10.0,
                                "occupancy_pct": 5, "timestamp": "2024-01-01T00:00:00.000+00:00"}) + "\n")
    from citylens.sources import route_schedule
    routes = route_schedule(spark, f"{tmp_path}/routes.csv")
    rec = metrics.ProgressRecorder()
    spark.streams.addListener(rec)
    raw = read_topic_files(spark, f"{tmp_path}/gps", "bus_gps")
    qs = jobs.enrichment_job(raw, routes, f"{tmp_path}/enr", f"{tmp_path}/miss", f"{tmp_path}/ck",
                             trigger="available_now")
    for q in qs:
        q.awaitTermination()
    enr = spark.read.json(f"{tmp_path}/enr")
    vals = [json.loads(r.value) for r in enr.collect()]
    assert sorted(v["bus_id"] for v in vals) == ["B0", "B1", "B3"]
    assert {v["route_name"] for v in vals} == {"Harbour Line", "Local"}
    miss = [json.loads(r.value)["bus_id"] for r in spark.read.json(f"{tmp_path}/miss").collect()]
    assert miss == ["B2"]
    rep = metrics.lag_report(spark, qs)
    assert rep.count() >= 1
    spark.streams.removeListener(rec)


def test_dlq_job(spark, tmp_path):
    import os
    os.makedirs(f"{tmp_path}/aq")
    with open(f"{tmp_path}/aq/a.json", "w") as f:
        f.write('{"aqi": 10}\n{"aqi": 501, "pm25": -1}\n{bad\n[1]\n{"pm25": 3}\n')
    raw = read_topic_files(spark, f"{tmp_path}/aq", "city.air_quality")
    qs = jobs.dlq_job(raw, f"{tmp_path}/dlq", f"{tmp_path}/report", f"{tmp_path}/ck", trigger="available_now")
    for q in qs:
        q.awaitTermination()
    import json
    dl = sorted(json.loads(r.value)["error_reason"] for r in spark.read.json(f"{tmp_path}/dlq").collect())
    assert dl == ["aqi_out_of_range:501", "json_parse_error:payload is not a JSON object",
                  "json_parse_error:payload is not a JSON object", "null_aqi"]
    errors, totals = jobs.latest_report(spark, f"{tmp_path}/report")
    assert {(r.topic, r.error): r["count"] for r in errors.collect()} == {
        ("air_quality", "negative_pm25"): 1, ("air_quality", "aqi_out_of_range"): 1, ("air_quality", "json_parse_error"): 2,
        ("air_quality", "null_aqi"): 1}
    got = {r.topic: (r.valid, r.dlq, r.dlq_rate_pct) for r in totals.collect()}
    assert got["air_quality"] == got["TOTAL"] == (1, 4, 80.0) and got["bus_gps"] == (0, 0, None)


def _bunch_model(rows, gap, dur, dmax):
    """Meetings of each pair (an event near the other's latest position), then
    the pair's clock: started by a meeting, stopped by an alert once it has run
    ``dur``, started anew beyond twice that."""
    from tests_pairs import pairs_brute

    meetings = {}
    for i, j in pairs_brute(rows, dmax, gap):
        now = max((rows[i][2], i), (rows[j][2], j))
        meetings.setdefault((rows[i][0], *sorted((rows[i][1], rows[j][1]))), []).append(now)
    out = []
    for pair, seq in meetings.items():
        since = None
        for t, i in sorted(seq):
            ran = None if since is None else t - since
            if ran is not None and dur <= ran <= 2 * dur:
                out.append((*pair, i))
                since = None
            elif ran is None or ran > 2 * dur:
                since = t
    return sorted(out)


def test_bunching_clock_mode_matches_model(spark, tmp_path):
    rnd = random.Random(9)
    rows = []
    for i in range(600):
        rows.append((rnd.choice(["R1", "R2", "R1"]), f"B{rnd.randrange(5)}", i * 7 + rnd.randrange(5),
                     round(12.9 + rnd.random() * 0.003, 6), round(77.6 + rnd.random() * 0.003, 6)))
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(r, b, t0 + dt.timedelta(seconds=t), la, lo, i)
                                for i, (r, b, t, la, lo) in enumerate(rows)],
                               "route_id string, bus_id string, timestamp timestamp, lat double, lon double, "
                               "event_id long")
    # four files in time order (the file source takes them by modification time)
    import os
    os.makedirs(f"{tmp_path}/bus")
    pdf = df.toPandas().sort_values("event_id")
    pdf["timestamp"] = pdf["timestamp"].dt.tz_localize("UTC")
    for i in range(4):
        f = f"{tmp_path}/bus/part-{i}.parquet"
        pdf.iloc[i * 150:(i + 1) * 150].to_parquet(f, index=False, coerce_timestamps="us")
        os.utime(f, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    st = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/bus")
    out = stateful.bunching_stream(st.withWatermark("timestamp", "10 minutes"), max_distance_m=200.0,
                                   max_gap=60, duration=120)
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck") \
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    got = sorted((r.route_id, r.bus_1, r.bus_2, r.event_id) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert len(got) > 10 and got == _bunch_model(rows, 60, 120, 200.0)


def test_gridlock_stream_orders_a_late_row_across_batches(spark, tmp_path):
    import os
    t0 = dt.datetime(2024, 1, 1)
    os.makedirs(f"{tmp_path}/tr")
    batches = [[(100, 1), (200, 2)], [(150, 3), (300, 4)]]   # 150 arrives one batch late
    schema = "junction_id string, zone string, avg_wait_sec int, timestamp timestamp, event_id long"
    for i, rows in enumerate(batches):
        pdf = spark.createDataFrame([("J", "Z", 181, t0 + dt.timedelta(seconds=s), e) for s, e in rows],
                                    schema).toPandas()
        pdf["timestamp"] = pdf["timestamp"].dt.tz_localize("UTC")
        f = f"{tmp_path}/tr/part-{i}.parquet"
        pdf.to_parquet(f, index=False, coerce_timestamps="us")
        os.utime(f, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    st = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/tr")
    out = stateful.consecutive_breach_stream(st.withWatermark("timestamp", "10 minutes"), "junction_id",
                                             "timestamp", "avg_wait_sec", 180, 3, 300)
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/ck") \
        .trigger(availableNow=True).start(f"{tmp_path}/out")
    q.awaitTermination()
    # 150 has only one earlier reading (100): no alert; 300 sees 150, 200, 300: alert
    assert sorted(r.event_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [4]
