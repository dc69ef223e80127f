"""Detectors: boundary fixtures and randomized checks against small sequential
models written from the rules (one key holds a third of the rows; small
chunk sizes force halos and cross-chunk carries)."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests_pairs import pairs_brute

from citylens.operators import detect
from citylens.operators.sequence import island_starts

T0 = dt.datetime(2024, 1, 1)


def at(sec: float) -> dt.datetime:
    return T0 + dt.timedelta(microseconds=round(sec * 1_000_000))


# --------------------------------------------------------------- cooldown (T7)
def _cool_df(spark, rows):
    return spark.createDataFrame([(k, at(t), i, a) for i, (k, t, a) in enumerate(rows)],
                                 "k string, ts timestamp_ntz, id long, aqi int")


def _cool(spark, rows, cooldown=120):
    df = _cool_df(spark, rows)
    out = detect.cooldown_alerts(df, "k", "ts", F.col("aqi") > 300, cooldown, id_col="id")
    return sorted(r.id for r in out.collect())


def test_cooldown_boundaries(spark):
    rows = [("s", 0, 300),        # 0: not above 300
            ("s", 1, 301),        # 1: alert
            ("s", 120.999, 400),  # 2: 119.999 s later -> suppressed
            ("s", 121, 400),      # 3: exactly 120 s -> alert
            ("s", 122, None),     # 4: null -> nothing
            ("s", 200, 350),      # 5: suppressed (79 s)
            ("s", 241, 350),      # 6: 120 s after the alert at 121 (suppressed breach did not restart)
            ("t", 241, 350)]      # 7: other key, independent
    assert _cool(spark, rows) == [1, 3, 6, 7]


def test_cooldown_segments(spark):
    # spaced exactly one cooldown apart: every breach starts a segment and fires (no chain rounds)
    assert _cool(spark, [("s", 120 * i, 400) for i in range(6)]) == list(range(6))
    # spaced just under it: one long segment, alerts alternate
    assert _cool(spark, [("s", 119.999999 * i, 400) for i in range(6)]) == [0, 2, 4]


def _cool_model(rows, cooldown):
    last, out = {}, []
    for i, (k, t, a) in sorted(enumerate(rows), key=lambda x: (x[1][1], x[0])):
        if a is None or a <= 300:
            continue
        if k not in last or t - last[k] >= cooldown:
            last[k] = t
            out.append(i)
    return sorted(out)


def test_cooldown_random_hot_key(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(900):
        k = "hot" if rnd.random() < 1 / 3 else f"s{rnd.randrange(12)}"
        rows.append((k, rnd.randrange(0, 20000) + rnd.choice([0, 0.5]), rnd.choice([250, 301, 320, 400, None])))
    assert _cool(spark, rows, 60) == _cool_model(rows, 60)


# --------------------------------------------------------------- consecutive (T8)
def _consec(spark, rows, chunk_s=None, within=300):
    df = spark.createDataFrame([(k, at(t), i, w) for i, (k, t, w) in enumerate(rows)],
                               "k string, ts timestamp_ntz, id long, w int")
    out = detect.consecutive_breach(df, "k", "ts", "w", 180, 3, within, order=["id"], chunk_s=chunk_s)
    return sorted(r.id for r in out.collect())


def test_consecutive_boundaries(spark):
    rows = [("a", 0, 181), ("a", 10, 181), ("a", 20, 180),                    # none
            ("b", 0, 181), ("b", 100, 181), ("b", 200, 181), ("b", 250, 181),  # 6 and 7 fire
            ("c", 0, 181), ("c", 150, 181), ("c", 300, 181),                  # exactly 300 s -> fires
            ("d", 0, 181), ("d", 150, 181), ("d", 300.000001, 181),           # 300.000001 s -> none
            ("e", 0, 190), ("e", 1, 190)]                                      # two readings -> none
    assert _consec(spark, rows) == [5, 6, 9]


def test_consecutive_missing_reading_breaks_run(spark):
    rows = [("a", 0, 181), ("a", 10, None), ("a", 20, 181), ("a", 30, 181), ("a", 40, 181)]
    assert _consec(spark, rows) == [4]


def _consec_model(rows, within, n=3, thr=180):
    by = {}
    for i, (k, t, w) in enumerate(rows):
        by.setdefault(k, []).append((t, i, w))
    out = []
    for k, seq in by.items():
        seq.sort()
        for j in range(n - 1, len(seq)):
            last = seq[j - n + 1:j + 1]
            if all(w > thr for _, _, w in last) and last[0][0] >= seq[j][0] - within:
                out.append(seq[j][1])
    return sorted(out)


def test_consecutive_random_hot_key_small_chunks(spark):
    rnd = random.Random(3)
    rows = []
    for _ in range(1200):
        k = "hot" if rnd.random() < 1 / 3 else f"j{rnd.randrange(10)}"
        rows.append((k, rnd.randrange(0, 30000), rnd.choice([170, 185, 190, 200])))
    # chunk of 600 s with a 300 s look-back: many chunk borders inside the hot key
    assert _consec(spark, rows, chunk_s=600) == _consec_model(rows, 300)


# --------------------------------------------------------------- islands / proximity (J5, T9)
def test_island_starts_match_model(spark):
    rnd = random.Random(11)
    rows = [("hot" if rnd.random() < 0.4 else f"p{rnd.randrange(5)}", rnd.randrange(0, 50000))
            for _ in range(1500)]
    df = spark.createDataFrame([(k, at(t), i) for i, (k, t) in enumerate(rows)], "k string, ts timestamp_ntz, id long")
    got = {r.id: r.island_start for r in island_starts(df, ["k"], "ts", 90, order=["id"], chunk_s=400).collect()}
    by = {}
    for i, (k, t) in enumerate(rows):
        by.setdefault(k, []).append((t, i))
    for k, seq in by.items():
        seq.sort()
        start = None
        prev = None
        for t, i in seq:
            if prev is None or t - prev > 90:
                start = t
            prev = t
            assert got[i] == (T0 + dt.timedelta(seconds=start) - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def _bus(spark, rows):
    return spark.createDataFrame([(r, b, at(t), la, lo, i) for i, (r, b, t, la, lo) in enumerate(rows)],
                                 "route string, bus string, ts timestamp_ntz, lat double, lon double, id long")


def test_proximity_boundaries(spark):
    # same meridian: 0.0017966 deg of latitude ~ 199.8 m, 0.0018 deg ~ 200.15 m
    rows = [("R1", "B1", 0, 12.9, 77.6), ("R1", "B2", 60, 12.9017966, 77.6),   # 60 s, ~199.8 m -> pair
            ("R1", "B3", 0, 12.9, 77.7), ("R1", "B4", 10, 12.9018, 77.7),       # ~200.15 m -> none
            ("R1", "B5", 0, 12.8, 77.8), ("R1", "B6", 61, 12.8, 77.8),          # 61 s -> none
            ("R2", "B1", 0, 12.9, 77.6),                                        # other route vs R1 -> none
            ("R3", "B9", 0, 13.0, 77.5), ("R3", "B9", 5, 13.0, 77.5)]           # one bus only -> none
    p = detect.proximity_pairs(_bus(spark, rows), "route", "bus", "ts", "lat", "lon", 200.0, 60, id_col="id")
    got = sorted((r.route, r.bus_1, r.bus_2) for r in p.collect())
    assert got == [("R1", "B1", "B2")]


def test_proximity_threshold_inclusive(spark):
    rows = [("R", "A", 0, 12.9, 77.6), ("R", "B", 0, 12.9011, 77.6013)]
    df = _bus(spark, rows)
    d = detect.proximity_pairs(df, "route", "bus", "ts", "lat", "lon", 1000.0, 60, id_col="id").first().distance_m
    assert detect.proximity_pairs(df, "route", "bus", "ts", "lat", "lon", d, 60, id_col="id").count() == 1


def test_proximity_pairs_match_brute_force(spark):
    import math
    rnd = random.Random(5)
    rows = []
    for _ in range(700):
        r = "hot" if rnd.random() < 1 / 3 else f"R{rnd.randrange(4)}"
        rows.append((r, f"B{rnd.randrange(15)}", rnd.randrange(0, 3000),
                     round(12.9 + rnd.random() * 0.01, 6), round(77.6 + rnd.random() * 0.01, 6)))
    got = sorted((r.id_1, r.id_2) for r in detect.proximity_pairs(
        _bus(spark, rows), "route", "bus", "ts", "lat", "lon", 300.0, 60, id_col="id").collect())
    want = pairs_brute(rows, 300.0, 60)
    assert len(want) > 50 and got == want


def test_proximity_is_to_the_latest_position(spark):
    # A leaves the stop at 0 and is 1.1 km away at 30; B reaches the stop at 45
    rows = [("R", "A", 0, 12.9, 77.6), ("R", "A", 30, 12.91, 77.6), ("R", "B", 45, 12.9, 77.6)]
    assert detect.proximity_pairs(_bus(spark, rows), "route", "bus", "ts", "lat", "lon", 200.0, 60, id_col="id").count() == 0


def test_parked_buses_give_a_row_per_sighting(spark):
    rows = [("R", b, t / 4, 12.9, 77.6) for t in range(480) for b in ("A", "B")]
    assert detect.proximity_pairs(_bus(spark, rows), "route", "bus", "ts", "lat", "lon", 200.0, 60, id_col="id").count() == 959


def test_crowded_instants_cost_their_rows(spark, monkeypatch, capsys):
    # many sightings of each bus at one instant, ties resolved by id: no join of sightings with sightings
    rnd = random.Random(23)
    rows = [("R", f"B{rnd.randrange(6)}", rnd.randrange(4) * 40, round(12.9 + rnd.random() * 0.004, 6), 77.6) for _ in range(1500)]
    monkeypatch.setattr(detect, "_ROWS", 64)
    monkeypatch.setattr(detect, "_PAIRS", 100)
    p = detect.proximity_pairs(_bus(spark, rows), "route", "bus", "ts", "lat", "lon", 200.0, 60, id_col="id")
    got = sorted((r.id_1, r.id_2) for r in p.collect())
    assert len(got) > 500 and got == pairs_brute(rows, 200.0, 60)
    p.explain()
    assert "Join" not in capsys.readouterr().out


def test_proximity_incident_duration_limit(spark):
    # a pair seen close every 50 s for exactly 300 s -> one incident; another for 250 s -> none
    rows = []
    for t in range(0, 301, 50):
        rows += [("R", "B1", t, 12.9, 77.6), ("R", "B2", t, 12.9001, 77.6)]
    for t in range(1000, 1251, 50):
        rows += [("R", "B3", t, 12.9, 77.6), ("R", "B4", t, 12.9001, 77.6)]
    p = detect.proximity_pairs(_bus(spark, rows), "route", "bus", "ts", "lat", "lon", 200.0, 60, id_col="id")
    inc = detect.proximity_incidents(p, "route", "bus", 300, 60).collect()
    assert [(r.bus_1, r.bus_2, r.duration_sec) for r in inc] == [("B1", "B2", 300.0)]


# --------------------------------------------------------------- late drop (T3)
def test_late_boundaries(spark):
    rows = [(0, "aq", 100.0), (1, "aq", 70.0),      # exactly max-30 s -> kept
            (2, "aq", 69.999), (3, "bus", 10.0),    # 1 ms older -> late; other topic untouched
            (4, "aq", 130.0), (5, "aq", 100.0)]     # max now 130 -> 100 kept
    df = spark.createDataFrame([(i, tp, at(t)) for i, tp, t in rows], "id long, topic string, ts timestamp_ntz")
    late = sorted(r.id for r in detect.mark_late(df, "topic", "ts", "id", 30).filter("is_late").collect())
    assert late == [2]


def test_late_random_small_blocks(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["a", "b", "hot", "hot"]), rnd.randrange(0, 5000) + i * 3) for i in range(800)]
    df = spark.createDataFrame([(i, tp, at(t)) for i, tp, t in rows], "id long, topic string, ts timestamp_ntz")
    got = sorted(r.id for r in detect.mark_late(df, "topic", "ts", "id", 120, chunk_rows=16).filter("is_late").collect())
    mx, want = {}, []
    for i, tp, t in rows:
        if tp in mx and t < mx[tp] - 120:
            want.append(i)
        mx[tp] = max(mx.get(tp, t), t)
    assert got == want


def test_incident_job_drops_late_events_first(spark):
    t = lambda s: at(s)
    aq = spark.createDataFrame([
        (0, "AQ-1", "N", 350, t(1000)),   # alert
        (1, "AQ-1", "N", 10, t(2000)),    # watermark -> 1970
        (2, "AQ-2", "N", 400, t(1900)),   # late (70 s behind the max): dropped, no alert
        (3, "AQ-2", "N", 400, t(1975)),   # within 30 s: kept, alert
    ], "arrival long, sensor_id string, zone string, aqi int, timestamp timestamp_ntz").withColumn("pm25", F.lit(140.0))
    tr = spark.createDataFrame([], "arrival long, junction_id string, zone string, avg_wait_sec int, "
                                   "timestamp timestamp_ntz")
    bus = spark.createDataFrame([], "arrival long, route_id string, bus_id string, lat double, lon double, "
                                    "timestamp timestamp_ntz")
    inc = detect.incidents(aq, tr, bus, arrival="arrival", lateness=30).collect()
    assert sorted((r.incident_type, r.sensor_id, r.aqi, r.pm25, r.threshold) for r in inc) == [
        ("AQI_EMERGENCY", "AQ-1", 350.0, 140.0, 300.0), ("AQI_EMERGENCY", "AQ-2", 400.0, 140.0, 300.0)]
    assert all(r.alert_time is not None for r in inc)
    assert all(r.message.startswith("HAZARDOUS AQI") for r in inc)


def test_rows_without_key_are_ignored(spark):
    rows = [(None, 0, 400), (None, 100, 400), ("a", 0, 400)]
    assert _cool(spark, rows) == [2]
    g = [(None, 0, 181), (None, 1, 181), (None, 2, 181), ("a", 0, 181), ("a", 1, 181), ("a", 2, 181)]
    assert _consec(spark, g) == [5]


def test_detectors_on_empty_input(spark):
    empty = spark.createDataFrame([], "k string, ts timestamp_ntz, id long, v int, lat double, lon double, e string")
    assert detect.cooldown_alerts(empty, "k", "ts", F.col("v") > 1, 60, id_col="id").count() == 0
    assert detect.consecutive_breach(empty, "k", "ts", "v", 1, 3, 60).count() == 0
    p = detect.proximity_pairs(empty, "k", "e", "ts", "lat", "lon", 100.0, 60, id_col="id")
    assert p.count() == 0 and detect.proximity_incidents(p, "k", "e", 60, 60).count() == 0
    assert detect.mark_late(empty, "k", "ts", "id", 30).count() == 0


def test_proximity_antimeridian_and_pole(spark):
    rnd = random.Random(17)
    rows = []
    for _ in range(400):   # straddling the antimeridian
        lon = rnd.uniform(179.99, 180.0) if rnd.random() < 0.5 else rnd.uniform(-180.0, -179.99)
        rows.append(("R", f"B{rnd.randrange(20)}", rnd.randrange(0, 600), rnd.uniform(-0.005, 0.005), lon))
    for _ in range(400):   # a few hundred metres from the north pole
        rows.append(("P", f"B{rnd.randrange(20)}", rnd.randrange(0, 600), rnd.uniform(89.995, 90.0),
                     rnd.uniform(-180.0, 180.0)))
    got = sorted((r.id_1, r.id_2) for r in detect.proximity_pairs(
        _bus(spark, rows), "route", "bus", "ts", "lat", "lon", 300.0, 60, id_col="id").collect())
    want = pairs_brute(rows, 300.0, 60)
    assert len(want) > 50 and got == want
