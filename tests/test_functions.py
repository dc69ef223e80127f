import datetime as dt
import math

from pyspark.sql import functions as F

from citylens.functions import (advisory_level, aqi_from_pm25, bucket_label, haversine_m,
                                parse_iso_ts)


def test_haversine_known_values(spark):
    df = spark.createDataFrame([(12.9, 77.6, 12.9, 77.6), (0.0, 0.0, 1.0, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m("a", "b", "c", "d")).collect()]
    assert got[0] == 0.0
    assert math.isclose(got[1], 111194.93, abs_tol=0.01)


def test_aqi_from_pm25_truncates_and_clamps(spark):
    df = spark.createDataFrame([(v,) for v in (-3.0, 0.0, 10.39, 60.0, 199.99, 250.0, 1e12)], "p double")
    got = [r[0] for r in df.select(aqi_from_pm25("p")).collect()]
    assert got == [0, 0, 25, 150, 499, 500, 500]


def test_bucket_label_and_tumbling_boundary(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 15, 0),), (dt.datetime(2024, 1, 1, 0, 14, 59, 999000),)],
                               "t timestamp_ntz")
    got = df.select(bucket_label("t", 900).alias("l"), F.window("t", "15 minutes").start.alias("s")).collect()
    assert got[0].l == "2024-01-01T00:15" and got[0].s == dt.datetime(2024, 1, 1, 0, 15)
    assert got[1].l == "2024-01-01T00:00"


def test_parse_iso_variants(spark):
    rows = [("2024-01-01T10:00:00.123+00:00",), ("2024-01-01T10:00:00Z",), ("2024-01-01T10:00:00.123456Z",),
            ("not a time",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "s string").select(
        parse_iso_ts("s").cast("timestamp_ntz")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 10, 0, 0, 123000)
    assert got[1] == dt.datetime(2024, 1, 1, 10, 0, 0)
    assert got[2] == dt.datetime(2024, 1, 1, 10, 0, 0, 123456)
    assert got[3] is None and got[4] is None


def test_advisory_level_boundaries(spark):
    df = spark.createDataFrame([(300.0,), (300.1,)], "a double")
    assert [r[0] for r in df.select(advisory_level("a")).collect()] == ["UNHEALTHY", "HAZARDOUS"]


def test_fixed_and_py_round_match_python(spark):
    from citylens.functions import fixed, py_round
    vals = [0.25, 0.35, 2.5, 3.5, 1234.5, 2.675, -0.4, 199.96, 1e6 + 0.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select(fixed("x", 0).alias("a"), fixed("x", 1).alias("b"), py_round("x", 2).alias("c")).collect()
    assert [r.a for r in got] == [f"{v:.0f}" for v in vals]
    assert [r.b for r in got] == [f"{v:.1f}" for v in vals]
    assert [r.c for r in got] == [round(v, 2) for v in vals]


def test_sums_keep_every_digit(spark):
    from citylens.functions.scalar import fixed_avg, fixed_sum, number_text

    def total(values):
        return spark.createDataFrame([(v,) for v in values], "v double").agg(fixed_sum("v").alias("s"), fixed_avg("v").alias("m")).first()

    assert total([0.004] * 10)["s"] == 0.04 and total([0.1] * 10)["s"] == 1.0
    assert total([1e17, 1.5])["s"] == 1e17 + 1.5 and total([1e-14] * 4)["s"] == 4e-14       # finer or larger than the decimal: doubles
    assert total([1.0, None, 2.0])["m"] == 1.5 and total([None])["s"] is None
    assert [r[0] for r in spark.createDataFrame([(350.0,), (350.5,), (-0.5,), (None,)], "v double").select(number_text("v")).collect()] == ["350", "350.5", "-0.5", None]


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    import pytest

    from citylens.session import checkpoint_dir

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None, getConf=lambda: {}, setCheckpointDir=lambda d: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=context, conf={}))
