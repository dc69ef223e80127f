"""Every registered query against its independent SQL answer (DuckDB) on
the smallest generated tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    from check_oracle import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    import __spark_entry__ as E
    return sorted(E.queries())


@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from check_oracle import _rows

    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(got.columns) > 0
        return
    want = duck.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _rows(got, False) == _rows(want, False)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["ward_id", "window_start", "window_end", "total_kwh_consumed",
                          "avg_power_factor", "peak_voltage", "date"]
