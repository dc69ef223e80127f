"""Plan shape: the properties the operators rely on at scale."""

import re

from citylens.plans import catalog as C

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_window_aggregate_is_partial_then_one_exchange(spark):
    p = _plan(C.ward_energy_15m(spark, SF))
    assert "partial_sum" in p and "partial_max" in p
    assert p.count("Exchange hashpartitioning") == 1


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(C.retention_7d(spark, SF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string>", p)
    e = _plan(C.enrich_unmatched(spark, SF))
    assert "Not(EqualTo(c_mktsegment,BUILDING))" in e


def test_sequential_rules_partition_by_key_and_time_chunk(spark):
    from citylens.operators import detect
    from citylens.plans import mapping as M
    tr = M.traffic_signals(M.events(spark, SF))
    p = _plan(detect.consecutive_breach(tr, "junction_id", "timestamp", "avg_wait_sec", 40, 3, "3 days"))
    # the window is partitioned by (key, chunk), never by the key alone
    assert "Window" in p
    assert re.search(r"hashpartitioning\(junction_id#\d+, __chunk#\d+L?", p)


def test_unbounded_dimension_is_not_force_broadcast(spark):
    from citylens.operators import enrich
    big = spark.range(50_000).withColumnRenamed("id", "k")
    stream = spark.range(10).withColumnRenamed("id", "k")
    j = enrich.enrich(stream, big, "k", max_broadcast_rows=1000)
    assert "broadcast" not in _optimized(j).lower()


def test_validator_runs_in_one_projection_without_shuffle(spark):
    p = _plan(C.dlq_split(spark, SF))
    assert "Exchange" not in p


def test_error_queries_parse_each_payload_once(spark):
    """No rule expression is pushed below the validator: one JSON extraction in the plan."""
    from citylens.plans import catalog

    for name in ("dlq_errors", "dlq_error_types", "dlq_error_distribution", "dlq_top_errors"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, name
