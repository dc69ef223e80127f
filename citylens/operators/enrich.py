"""Stream-to-dimension enrichment joins.

Broadcast policy: a dimension is broadcast only behind a size check.
``bounded_broadcast`` turns a byte budget into a row budget (row width
estimated from the schema), counts at most ``rows + 1`` rows of the
dimension (a limit, so the check itself is bounded work) and hints a
broadcast only when the dimension fits; otherwise the join is left to the
planner -- a shuffle join whose strategy AQE may still switch to broadcast
from *measured* shuffle sizes.  A dimension that grows with the data is
therefore never shipped to every executor on faith.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 << 20


def _width(t: T.DataType) -> int:
    if isinstance(t, T.StructType):
        return sum(_width(f.dataType) for f in t.fields)
    if isinstance(t, (T.ArrayType, T.MapType)):
        return 64
    if isinstance(t, (T.StringType, T.BinaryType, T.VariantType)):
        return 32
    if isinstance(t, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(t, T.ShortType):
        return 2
    if isinstance(t, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(t, T.DecimalType):
        return 8 if t.precision <= 18 else 16
    return 8


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the column types (strings 32 bytes)."""
    return max(1, _width(df.schema))


def bounded_broadcast(dim: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(dim)`` if it has at most ``max_rows`` rows and about
    ``max_bytes`` bytes, else ``dim`` (left to the planner)."""
    if dim.isStreaming:
        return dim
    rows = min(max_rows, max_bytes // row_width(dim))
    n = dim.limit(rows + 1).count()
    return F.broadcast(dim) if n <= rows else dim


def _on(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _dedupe(dim: DataFrame, on: list[str], order: str | None) -> DataFrame:
    """One row per key: the last by ``order`` (the lookup-table rule "last row
    wins").  Without an order column the caller guarantees unique keys."""
    if order is None:
        return dim
    rest = [c for c in dim.columns if c not in on]
    last = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order))
    return dim.groupBy(*on).agg(last.alias("__d")).select(*on, *[F.col(f"__d.{c}").alias(c) for c in rest])


def file_order(df: DataFrame) -> Column:
    """The place of each row among the files ``df`` is read from: path, block,
    row within the block.  Spark packs the blocks of several files into tasks
    by size, so row numbers of the plan alone say nothing of the order of files;
    within a block rows are read in order."""
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def last_row_wins(dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """One row per key of a dimension read as a batch: the last in the order of
    its files (by path) and of their rows; a dimension that is not read from
    files has the order of its rows.  The places are written (a checkpoint),
    because a plan that numbers rows cannot be part of a streaming query."""
    place = file_order(dim) if dim.inputFiles() else F.monotonically_increasing_id()
    return _dedupe(dim.withColumn("__row", place).checkpoint(), list(on), "__row").drop("__row")


def enrich(stream: DataFrame, dim: DataFrame, on: str | Sequence[str] = "route_id",
           how: str = "inner", dedupe_by: str | None = None,
           max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Attach dimension columns to each event (inner: unmatched dropped;
    left: unmatched kept with NULL dimension columns)."""
    keys = _on(on)
    d = bounded_broadcast(_dedupe(dim, keys, dedupe_by), max_broadcast_rows)
    return stream.join(d, keys, how)


def unmatched(stream: DataFrame, dim: DataFrame, on: str | Sequence[str] = "route_id",
              max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Events whose key has no dimension row (``left_anti``)."""
    keys = _on(on)
    d = bounded_broadcast(dim.select(*keys), max_broadcast_rows)
    return stream.join(d, keys, "left_anti")


def enrich_with_defaults(stream: DataFrame, dim: DataFrame, on: str | Sequence[str],
                         defaults: dict[str, Column | str | int | float],
                         max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Left join; for unmatched keys the listed dimension columns take a
    default (a literal, or a Column such as the key itself)."""
    keys = _on(on)
    joined = enrich(stream, dim, keys, "left", max_broadcast_rows=max_broadcast_rows)
    for c, v in defaults.items():
        dv = v if isinstance(v, Column) else F.lit(v)
        joined = joined.withColumn(c, F.coalesce(F.col(c), dv))
    return joined


def match_counts(stream: DataFrame, dim: DataFrame, on: str | Sequence[str],
                 max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Running counters of the enrichment job: joined vs. unmatched events."""
    keys = _on(on)
    d = bounded_broadcast(dim.select(*keys).distinct().withColumn("__hit", F.lit(True)),
                          max_broadcast_rows)
    j = stream.select(*keys).join(d, keys, "left")
    return j.agg(F.count_if(F.col("__hit").isNotNull()).alias("joined"),
                 F.count_if(F.col("__hit").isNull()).alias("unmatched"))
