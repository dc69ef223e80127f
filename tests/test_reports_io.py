import datetime as dt
import os

from pyspark.sql import functions as F

from citylens.operators import enrich, reports, windows
from citylens.sinks import kafka_sink_options, trigger_args
from citylens.sources import kafka_options, read_topic_files
from citylens.streaming import jobs, metrics


def test_presentation_rounding_half_even(spark):
    df = spark.createDataFrame([(1.0005, 0.86125, 230.25)],
                               "total_kwh_consumed double, avg_power_factor double, peak_voltage double")
    r = reports.present_ward_energy(df).first()
    assert (r.total_kwh_consumed, r.avg_power_factor, r.peak_voltage) == (1.0, 0.8612, 230.2)
    a = reports.present_advisory(spark.createDataFrame([(150.25,)], "rolling_avg_aqi double")).first()
    assert a.rolling_avg_aqi == 150.2


def test_top_k_and_export(spark, tmp_path):
    df = spark.createDataFrame([(f"e{i}", i % 7) for i in range(50)], "error string, count int")
    top = reports.top_k(df, [F.desc("count"), "error"], 3).collect()
    assert [r.error for r in top] == ["e13", "e20", "e27"]
    reports.export(df, f"{tmp_path}/csv", "csv")
    back = spark.read.option("header", "true").csv(f"{tmp_path}/csv")
    assert back.count() == 50 and back.columns == ["error", "count"]


def test_keyed_order(spark):
    df = spark.createDataFrame([("b", 2), ("a", 3), ("b", 1), ("a", 1)], "k string, t int")
    parts = reports.keyed_order(df, "k", "t", 2).rdd.glom().collect()
    for p in parts:
        keys = [r.k for r in p]
        assert all(keys.count(k) == len([r for r in p if r.k == k]) for k in keys)
        for k in set(keys):
            ts = [r.t for r in p if r.k == k]
            assert ts == sorted(ts)


def test_retain_and_latest(spark):
    t = dt.datetime(2024, 1, 10)
    df = spark.createDataFrame([(1, "s", t), (2, "s", t - dt.timedelta(days=8)), (3, "x", t)],
                               "id int, k string, ts timestamp_ntz")
    assert sorted(r.id for r in windows.retain(df, "ts", "7 days", "2024-01-10 00:00:00").collect()) == [1, 3]
    got = {r.k: r.id for r in windows.latest_per_key(df, ["k"], ["ts", "id"], ["id"]).collect()}
    assert got == {"s": 1, "x": 3}


def test_bounded_broadcast_checks_size(spark):
    small = spark.range(100)
    assert "broadcast" in str(enrich.bounded_broadcast(small)._jdf.queryExecution().logical()).lower()
    big = spark.range(10_000)
    assert "broadcast" not in str(enrich.bounded_broadcast(big, max_rows=1000)._jdf.queryExecution().logical()).lower()
    assert "broadcast" not in str(enrich.bounded_broadcast(big, max_bytes=8 * 1000)._jdf.queryExecution().logical()).lower()


def test_option_builders():
    o = kafka_options("b:9092", ["city.bus_gps", "city.air_quality"], "earliest",
                      max_offsets_per_trigger=1000)
    assert o["subscribe"] == "city.bus_gps,city.air_quality" and o["maxOffsetsPerTrigger"] == "1000"
    k = kafka_sink_options("b:9092", "city.incidents")
    assert k["kafka.acks"] == "all" and k["kafka.compression.type"] == "lz4"
    assert trigger_args("5 seconds") == {"processingTime": "5 seconds"}
    assert trigger_args("available_now") == {"availableNow": True}


def test_independent_consumers_and_lag(spark, tmp_path):
    os.makedirs(f"{tmp_path}/src")
    for i in range(4):
        with open(f"{tmp_path}/src/f{i}.json", "w") as f:
            f.write("\n".join('{"junction_id": "J%d", "avg_wait_sec": %d}' % (j, j) for j in range(10)) + "\n")
        os.utime(f"{tmp_path}/src/f{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))
    fast = read_topic_files(spark, f"{tmp_path}/src", "traffic_signals")
    slow = read_topic_files(spark, f"{tmp_path}/src", "traffic_signals", max_files_per_trigger=1)
    qs = jobs.independent_consumers(fast, slow, f"{tmp_path}/fast", f"{tmp_path}/slow", f"{tmp_path}/ck",
                                    trigger="available_now")
    for q in qs:
        q.awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/fast").count() == 40
    assert spark.read.parquet(f"{tmp_path}/slow").count() == 40
    assert len(qs[1].recentProgress) >= 4 > len(qs[0].recentProgress) - 1
    rep = metrics.lag_report(spark, qs).collect()
    assert all(r.lag in (0, None) for r in rep)


def test_observed_counters(spark, tmp_path):
    os.makedirs(f"{tmp_path}/gps")
    with open(f"{tmp_path}/gps/a.json", "w") as f:
        f.write('{"bus_id": "B1", "route_id": "R1", "timestamp": "2024-01-01T00:00:00Z"}\n'
                '{"bus_id": "B2", "route_id": "R9", "timestamp": "2024-01-01T00:00:01Z"}\n'
                '{"bus_id": "B3", "route_id": "R1", "timestamp": "not a time"}\n')
    routes = spark.createDataFrame([("R1", "x", "t", "06:00", "15")],
                                   "route_id string, route_name string, terminal string, "
                                   "scheduled_arrival_time string, frequency_min string")
    qs = jobs.enrichment_job(read_topic_files(spark, f"{tmp_path}/gps", "bus_gps"), routes, f"{tmp_path}/o",
                             None, f"{tmp_path}/ck", trigger="available_now")
    qs[0].awaitTermination()
    obs = [p["observedMetrics"]["enrichment"] for p in qs[0].recentProgress
           if p.get("observedMetrics", {}).get("enrichment")]
    assert sum(int(o["joined"]) for o in obs) == 1 and sum(int(o["no_match"]) for o in obs) == 1


def test_the_package_ships_to_the_executors(spark):
    import zipfile
    from urllib.parse import urlparse

    from citylens.session import ship_package

    names = zipfile.ZipFile(urlparse(ship_package(spark)).path).namelist()
    assert {"citylens/__init__.py", "citylens/streaming/stateful.py"} <= set(names)
