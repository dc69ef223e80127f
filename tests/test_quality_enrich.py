import json

from pyspark.sql import functions as F

from citylens.functions import decode
from citylens.operators import enrich, quality
from citylens.schemas import AIR_QUALITY, ROUTE_SCHEDULE


def _check(spark, topic, payloads):
    df = spark.createDataFrame([(i, topic, p) for i, p in enumerate(payloads)], "id long, topic string, value string")
    out = quality.validate_payloads(df).orderBy("id").collect()
    return [list(r.errors) for r in out]


def test_air_quality_rules(spark):
    got = _check(spark, "air_quality", [json.dumps(x) for x in [
        {"aqi": -1}, {"aqi": 0}, {"aqi": 500}, {"aqi": 501}, {"aqi": None}, {},
        {"aqi": 10, "pm25": -0.1, "pm10": -2}, {"aqi": 10, "pm25": None}]])
    assert got == [["aqi_out_of_range:-1"], [], [], ["aqi_out_of_range:501"], ["null_aqi"], ["null_aqi"],
                   ["negative_pm25", "negative_pm10"], []]


def test_bus_rules_and_order(spark):
    got = _check(spark, "bus_gps", [json.dumps(x) for x in [
        {"lat": 12.88, "lon": 77.48, "speed_kmh": 120}, {"lat": 13.12, "lon": 77.75, "speed_kmh": 120.1},
        {"lat": 12.0, "lon": 78.0, "speed_kmh": -1.5}, {"speed_kmh": 10}]])
    assert got == [[], ["speed_too_high:120.1"],
                   ["impossible_lat:12.0", "impossible_lon:78.0", "negative_speed:-1.5"],
                   ["impossible_lat:0", "impossible_lon:0"]]


def test_meter_and_traffic_rules(spark):
    m = _check(spark, "smart_meters", [json.dumps(x) for x in [
        {"meter_id": "M", "voltage": 200, "power_factor": 0}, {"meter_id": "M", "voltage": 260, "power_factor": 1},
        {"meter_id": "M", "voltage": 199.9, "power_factor": 1.001}, {}]])
    assert m == [[], [], ["voltage_out_of_range:199.9", "power_factor_invalid:1.001"], ["null_meter_id"]]
    t = _check(spark, "traffic_signals", [json.dumps(x) for x in [
        {"junction_id": "J", "avg_wait_sec": -1, "vehicle_count": -2}, {"junction_id": "J"}, {}]])
    assert t == [["negative_wait_sec", "negative_vehicle_count"], [], ["null_junction_id"]]


def test_decode_failures(spark):
    got = _check(spark, "air_quality", ["{bad", "", "[1]", '"x"', None, '{"aqi": "abc"}'])
    assert [g[0].split(":")[0] for g in got[:5]] == ["json_parse_error"] * 5
    assert got[5] == ["null_aqi"]  # wrong-typed field reads as missing
    split = quality.validate_payloads(spark.createDataFrame([(1, "air_quality", '{"aqi": 1}'),
                                                             (2, "nope", "{}")], "id long, topic string, value string"))
    rows = {r.id: (r.is_valid, r.error_reason) for r in split.collect()}
    assert rows == {1: (True, None), 2: (False, "unknown_topic:nope")}


def test_decode_typed_drops_undecodable(spark):
    df = spark.createDataFrame([('{"sensor_id":"AQ-1","aqi":12,"timestamp":"2024-01-01T00:00:00.000+00:00"}',),
                                ("{bad",), ("[1]",), ('{"sensor_id":"AQ-2","timestamp":"garbage"}',)], "value string")
    out = decode(df, AIR_QUALITY).collect()
    assert [r.sensor_id for r in out] == ["AQ-1", "AQ-2"]
    assert out[0].aqi == 12 and out[1].timestamp is None
    assert [r.sensor_id for r in decode(df, AIR_QUALITY, require=("timestamp",)).collect()] == ["AQ-1"]


def test_error_report_counts_messages_not_errors(spark):
    df = spark.createDataFrame([(1, "bus_gps", '{"lat": 1, "lon": 1}'), (2, "bus_gps", '{"lat": 13, "lon": 77.6}')],
                               "id long, topic string, value string")
    chk = quality.validate_payloads(df)
    s = quality.dlq_summary(chk).collect()[0]
    assert (s.total, s.valid, s.dlq, s.dlq_rate_pct) == (2, 1, 1, 50.0)
    env = quality.dlq_envelope(chk, "topic", F.col("value")).collect()
    assert len(env) == 1 and env[0].error_reason == "impossible_lat:1.0" and len(env[0].all_errors) == 2


def test_enrich_unknown_route(spark):
    routes = spark.createDataFrame([("R001", "Harbour Line", "T1", "06:00", "15")], ROUTE_SCHEDULE)
    gps = spark.createDataFrame([("B1", "R001"), ("B2", "R999")], "bus_id string, route_id string")
    assert [r.bus_id for r in enrich.enrich(gps, routes, "route_id").collect()] == ["B1"]
    assert [r.bus_id for r in enrich.unmatched(gps, routes, "route_id").collect()] == ["B2"]
    c = enrich.match_counts(gps, routes, "route_id").first()
    assert (c.joined, c.unmatched) == (1, 1)


def test_enrich_last_row_wins_with_order(spark):
    routes = spark.createDataFrame([("R1", "old", 1), ("R1", "new", 2)], "route_id string, route_name string, seq int")
    gps = spark.createDataFrame([("B1", "R1")], "bus_id string, route_id string")
    assert enrich.enrich(gps, routes, "route_id", dedupe_by="seq").first().route_name == "new"
