"""Jobs on archived topics over several steps: state, offsets and sinks carry over."""

import datetime as dt
import os
import sys

import pytest

from citylens.functions.codec import decode, encode
from citylens.plans import landed as L
from citylens.plans.oracle import ORACLE
from citylens.sources.streams import Replay
from citylens.streaming.metrics import ProgressRecorder

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["stream_dlq_sink", "stream_incident_sink", "stream_bus_enriched", "stream_enrichment_counters",
                                  "stream_independent_consumers"])
def test_three_steps_answer_like_one(spark, monkeypatch, name):
    import duckdb
    from check_oracle import _rows

    made = []

    def sliced(*args, least=1):
        made.append(Replay(*args, least=3))
        return made[-1]

    monkeypatch.setattr(L, "Replay", sliced)
    got = L.LANDED_QUERIES[name](spark, SF).toPandas()
    con = duckdb.connect()
    for t in ("events", "supplier"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert made[0].slices == 3
    assert _rows(got, False) == _rows(con.execute(ORACLE[name]).df(), False)


def test_slices_hold_every_row_once(spark):
    r = Replay(spark, SF, "events", least=4)
    ids = [x["event_id"] for i in range(r.slices) for x in r.slice(i).select("event_id").collect()]
    assert r.slices == 4 and len(ids) == len(set(ids)) == spark.read.parquet(f"{SF}/events.parquet").count()


def test_messages_keep_microseconds(spark):
    at = dt.datetime(2024, 3, 1, 1, 2, 3, 456789)
    df = spark.createDataFrame([("k", at, at), ("n", None, None)], "key string, a timestamp, b timestamp_ntz")
    back = decode(encode(df, "key"), "key string, a timestamp, b timestamp_ntz", value="value").collect()
    assert [tuple(r) for r in back] == [("k", at, at), ("n", None, None)]


def test_recorder_counts_by_run(spark, tmp_path):
    rec, src = ProgressRecorder(keep=2), f"{tmp_path}/src"
    spark.streams.addListener(rec)
    try:
        total, runs = 0, []
        for i in range(3):
            spark.range(10 * (i + 1)).write.mode("append").parquet(src)
            q = (spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(src).writeStream.format("noop")
                 .option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start())
            q.awaitTermination()
            rec.wait(q)
            total, runs = total + 10 * (i + 1), [*runs, str(q.runId)]
        assert [rec.rows_processed(r) for r in runs] == [10, 20, 30] and rec.rows_processed() == total
        assert len(rec.events) == 2
    finally:
        spark.streams.removeListener(rec)
