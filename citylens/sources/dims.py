"""Static dimensions (CSV with header) read with an explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ROUTE_SCHEDULE, ZONE_PROFILE


def read_dimension(spark: SparkSession, path: str, schema, view: str | None = None) -> DataFrame:
    """CSV with a header row, typed by ``schema`` (no inference); a missing
    file fails at analysis time.  Optionally registered as a SQL view."""
    df = spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def zone_profile(spark: SparkSession, path: str, view: str | None = "zone_profile") -> DataFrame:
    return read_dimension(spark, path, ZONE_PROFILE, view)


def route_schedule(spark: SparkSession, path: str, view: str | None = "route_schedule") -> DataFrame:
    """Route lookup table; ``frequency_min`` stays a string as in the file."""
    return read_dimension(spark, path, ROUTE_SCHEDULE, view)
