import json
import os

from citylens import cli


def _lines(path, recs):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/a.json", "w") as f:
        for r in recs:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")


def test_cli_dlq_and_ward_energy(spark, tmp_path):
    src = f"{tmp_path}/src"
    ts = "2024-01-01T00:0%d:00.000+00:00"
    _lines(f"{src}/smart_meters", [{"meter_id": "M1", "ward_id": "W1", "kwh_reading": 1.5, "voltage": 230.0,
                                    "power_factor": 0.9, "timestamp": ts % i} for i in range(3)])
    _lines(f"{src}/air_quality", [{"sensor_id": "A", "aqi": 10, "timestamp": ts % 1}, "{broken"])
    _lines(f"{src}/bus_gps", [{"bus_id": "B", "route_id": "R", "lat": 1.0, "lon": 1.0, "timestamp": ts % 1}])
    _lines(f"{src}/traffic_signals", [{"junction_id": "J", "avg_wait_sec": 5, "timestamp": ts % 1}])
    cli.main(["ward-energy", "--files", src, "--out", f"{tmp_path}/we", "--checkpoints", f"{tmp_path}/ck1",
              "--trigger", "available_now"])
    got = [json.loads(r.value) for r in spark.read.json(f"{tmp_path}/we/summary").collect()]
    assert len(got) == 1 and got[0]["total_kwh_consumed"] == 4.5
    cli.main(["dlq", "--files", src, "--out", f"{tmp_path}/dlq", "--checkpoints", f"{tmp_path}/ck2",
              "--trigger", "available_now"])
    dl = sorted(json.loads(r.value)["original_topic"] for r in spark.read.json(f"{tmp_path}/dlq/dlq").collect())
    assert dl == ["air_quality", "bus_gps"]


def test_cli_incidents(spark, tmp_path):
    src, t = f"{tmp_path}/src", "2024-01-01T00:%02d:%02d.000+00:00"
    _lines(f"{src}/air_quality", [{"sensor_id": "A", "zone": "Z", "aqi": 350.5, "pm25": 140.2, "timestamp": t % (0, 5)},
                                  {"sensor_id": "A", "zone": "Z", "aqi": 360, "pm25": 144.0, "timestamp": t % (1, 5)}])
    _lines(f"{src}/traffic_signals", [{"junction_id": "J", "zone": "Z", "avg_wait_sec": w, "timestamp": t % (i, 0)} for i, w in enumerate((181, 181, 182.5))])
    _lines(f"{src}/bus_gps", [{"bus_id": b, "route_id": "R", "lat": 12.9, "lon": 77.6, "timestamp": t % (i, s)} for i in range(7) for b, s in (("B1", 0), ("B2", 1))])
    cli.main(["incidents", "--files", src, "--out", f"{tmp_path}/inc", "--checkpoints", f"{tmp_path}/ck", "--trigger", "available_now"])
    got = [json.loads(r.value) for kind in os.listdir(f"{tmp_path}/inc") for r in spark.read.json(f"{tmp_path}/inc/{kind}").collect()]
    by = {}
    for g in got:
        by.setdefault(g["incident_type"], []).append(g)
    (a,), (j,) = by["AQI_EMERGENCY"], by["TRAFFIC_GRIDLOCK"]
    assert (a["sensor_id"], a["aqi"], a["pm25"], a["threshold"]) == ("A", 350.5, 140.2, 300.0) and a["message"] == "HAZARDOUS AQI 350.5 at sensor A zone Z"
    assert (j["junction_id"], j["avg_wait_sec"], j["consecutive_readings"]) == ("J", 181.5, 3)
    assert {(b["route_id"], b["distance_m"], b["duration_sec"]) for b in by["BUS_BUNCHING"]} == {("R", 0.0, 300.0)}
    assert all(g["alert_time"] and g["event_time"] for g in got)


def test_cli_requires_a_source():
    import pytest
    with pytest.raises(SystemExit):
        cli.main(["dlq", "--out", "/x", "--checkpoints", "/y"])
