"""Report shaping and batch outputs built on the operator results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import round_half_even


def present_ward_energy(df: DataFrame) -> DataFrame:
    """Presentation rounding of ward summaries (half-even): kWh to 3
    decimals, power factor to 4, voltage to 1."""
    return (df.withColumn("total_kwh_consumed", round_half_even("total_kwh_consumed", 3))
              .withColumn("avg_power_factor", round_half_even("avg_power_factor", 4))
              .withColumn("peak_voltage", round_half_even("peak_voltage", 1)))


def present_advisory(df: DataFrame) -> DataFrame:
    """Average AQI to 1 decimal (half-even)."""
    return df.withColumn("rolling_avg_aqi", round_half_even("rolling_avg_aqi", 1))


def top_k(df: DataFrame, order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of a report in a stable order (a sample of an
    output for a human, as the demo prints).  Spark plans this as a
    per-partition top-k plus one merge (``TakeOrderedAndProject``), never a
    full sort."""
    return df.orderBy(*order).limit(k)


def keyed_order(df: DataFrame, key: str, ts: str, partitions: int) -> DataFrame:
    """Per-key ordering for file outputs: all rows of a key in one output
    partition, in event-time order (what a keyed topic guarantees)."""
    return df.repartition(partitions, F.col(key)).sortWithinPartitions(key, ts)


def export(df: DataFrame, path: str, fmt: str = "csv", partition_by: Sequence[str] = (),
           mode: str = "overwrite") -> None:
    """Write a report as CSV (with header), JSON lines or Parquet; one file
    per task -- no funnelling through a single writer."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", "true").csv(path)
    elif fmt == "json":
        w.json(path)
    else:
        w.parquet(path)


def aqi_history(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Air-quality history rows with the ``date`` partition column (stored
    partitioned by zone and date)."""
    return df.withColumn("date", F.to_date(F.col(ts)))
