"""Skew-safe building blocks for per-key sequential rules.

A window ``partitionBy(key)`` puts every row of a key into one task; with one
sensor or route carrying a third of the stream that task is the job.  The
rules in this library only ever look a bounded *time* back ("the last three
readings within 300 s", "the previous sighting within 60 s"), so the
timeline of a key is cut into chunks and each chunk gets a *halo*: copies of
the rows that lie within the look-back of its start.  Windows then run per
``(key, chunk)``; a hot key spreads over as many tasks as it has chunks.

Where state must cross arbitrarily many chunks (the start of a long
island, a running maximum), a two-level scan is used: one summary row per
``(key, chunk)``, a running aggregate over those summaries, and a join back.
The summary level holds one row per chunk -- it grows with the time span,
not with the number of events.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import epoch_micros

_UNITS = {"microsecond": 1e-6, "millisecond": 1e-3, "second": 1, "minute": 60, "hour": 3600,
          "day": 86400, "week": 604800}


def micros(d) -> int:
    """Duration in whole microseconds."""
    return int(round(seconds(d) * 1_000_000))


def seconds(d) -> float:
    """``300``, ``"300 seconds"``, ``"5 minutes"``, ``"2 days"`` -> seconds."""
    if isinstance(d, (int, float)):
        return float(d)
    m = re.fullmatch(r"\s*([0-9.]+)\s*([a-z]+?)s?\s*", str(d).lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"cannot read duration {d!r}")
    return float(m.group(1)) * _UNITS[m.group(2)]


def default_chunk(lookback_s: float) -> float:
    """Chunk length: a multiple of the look-back (so the halo is a small
    fraction of each chunk), at least one hour."""
    return max(16.0 * lookback_s, 3600.0)


def with_halo(df: DataFrame, ts: str, lookback_s: float, chunk_s: float | None = None) -> DataFrame:
    """Adds ``__t`` (epoch microseconds, exact), ``__chunk`` and ``__home``.
    Each row appears once in its own chunk (``__home``) and, if it lies
    within ``lookback_s`` of the next chunk's start, once more in that chunk
    as context."""
    chunk_s = float(chunk_s or default_chunk(lookback_s))
    if chunk_s < lookback_s:
        raise ValueError("chunk must be at least the look-back")
    chunk, look = micros(chunk_s), micros(lookback_s)
    t = epoch_micros(ts)
    c = F.floor(t / F.lit(chunk))
    near_next = t >= (c + 1) * F.lit(chunk) - F.lit(look)
    shift = F.explode(F.when(near_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return (df.withColumn("__t", t).withColumn("__c0", c)
              .select("*", shift.alias("__shift"))
              .withColumn("__chunk", F.col("__c0") + F.col("__shift"))
              .withColumn("__home", F.col("__shift") == 0)
              .drop("__c0", "__shift"))


def chunk_window(keys: Sequence[str], order: Sequence[str]) -> Window:
    return Window.partitionBy(*[F.col(k) for k in keys], F.col("__chunk")).orderBy(
        F.col("__t"), *[F.col(o) for o in order])


def island_starts(df: DataFrame, keys: Sequence[str], ts: str, max_gap_s: float,
                  order: Sequence[str] = (), chunk_s: float | None = None) -> DataFrame:
    """Gaps-and-islands: rows of a key whose consecutive times differ by at
    most ``max_gap_s`` form one island.  Adds ``island_start`` (epoch microseconds
    of the island's first row) to every row; the island is identified by
    ``(keys, island_start)``.

    Level 1, per (key, chunk) with halo: a row starts an island when its
    predecessor is absent or more than ``max_gap_s`` earlier; rows after a
    start in the same chunk take that start.  Level 2: rows of a chunk that
    precede its first start continue an island opened in an earlier chunk;
    its start is the running maximum of the per-chunk last starts.
    """
    chunk = float(chunk_s or default_chunk(max_gap_s))
    h = with_halo(df, ts, max_gap_s, chunk)
    w = chunk_window(keys, order)
    prev = F.lag("__t", 1).over(w)
    is_start = prev.isNull() | ((F.col("__t") - prev) > F.lit(micros(max_gap_s)))
    # Only home rows may start an island: a halo row's own predecessor may
    # lie outside the halo, so its start flag is unreliable.
    h = h.withColumn("__start", F.when(is_start & F.col("__home"), F.col("__t")))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = h.withColumn("__in_chunk", F.last("__start", ignorenulls=True).over(running))
    home = h.filter("__home")

    summary = home.groupBy(*keys, "__chunk").agg(F.max("__start").alias("__last_start"))
    sw = Window.partitionBy(*[F.col(k) for k in keys]).orderBy("__chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    carry = summary.select(*keys, "__chunk", F.max("__last_start").over(sw).alias("__carry"))
    out = home.join(carry, [*keys, "__chunk"], "left")
    return (out.withColumn("island_start", F.coalesce(F.col("__in_chunk"), F.col("__carry")))
               .drop("__start", "__in_chunk", "__carry", "__home", "__chunk"))


def exclusive_running_max(df: DataFrame, keys: Sequence[str], order: str, value: str,
                          chunk_rows: int = 1 << 20, out: str = "__prev_max") -> DataFrame:
    """``max(value)`` over all earlier rows of the key in ``order`` (an
    integer arrival position such as an offset), excluding the row itself.

    Two-level: running max inside each block of ``chunk_rows`` positions,
    plus the running max of earlier blocks' maxima.
    """
    blk = F.floor(F.col(order) / chunk_rows)
    d = df.withColumn("__blk", blk)
    w = Window.partitionBy(*[F.col(k) for k in keys], F.col("__blk")).orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    d = d.withColumn("__in_blk", F.max(value).over(w))
    summary = d.groupBy(*keys, "__blk").agg(F.max(value).alias("__blk_max"))
    sw = Window.partitionBy(*[F.col(k) for k in keys]).orderBy("__blk").rowsBetween(
        Window.unboundedPreceding, -1)
    carry = summary.select(*keys, "__blk", F.max("__blk_max").over(sw).alias("__carry"))
    d = d.join(carry, [*keys, "__blk"], "left")
    return (d.withColumn(out, F.greatest(F.col("__in_blk"), F.col("__carry")))
              .drop("__blk", "__in_blk", "__carry"))


def keyed_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position", parts: int | None = None) -> DataFrame:
    """``row_number()`` of each row within its key by ``order`` (ascending, nulls
    first), without a task that holds a key.

    The rows are dealt into ranges of ``order`` of equal size -- whatever their
    keys, so a key with a third of all rows lies in many ranges -- and written
    with the number of their range.  A row's position is its place within
    (key, range) plus the rows of the key in earlier ranges: a prefix sum over
    one count per key and range.
    """
    from ..session import parallelism, scratch_path

    spark = df.sparkSession
    parts = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), parallelism(spark))
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(parts, *order).withColumn("__range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    counts = dealt.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__range").alias("__r"),
                           F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    inside = dealt.withColumn("__place", F.row_number().over(Window.partitionBy(*keys, "__range").orderBy(*order)))
    same = F.col("__range") == F.col("__r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return inside.join(before, same).select(*df.columns, (F.col("__before") + F.col("__place")).cast("long").alias(out))
