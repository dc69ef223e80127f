"""Sinks: keyed JSON (Kafka or files), partitioned Parquet, and idempotent
per-window outputs for update-mode aggregates.

Update-mode output carries several versions of one window row.  Two ways to
land it in files, both safe under micro-batch replay after a failure:

* ``versioned_append`` -- every version is appended with its batch id;
  readers collapse with ``windows.latest_version``.  Cheapest write.
* ``upsert_partitions`` -- each batch rewrites only the partitions it
  touches with the newest row per key (dynamic partition overwrite), so the
  folder always holds exactly one row per window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.codec import encode
from ..session import scratch_path


def trigger_args(trigger: str | None) -> dict:
    """``"5 seconds"`` -> processing time; ``"available_now"`` -> drain what
    is there and stop (tests, backfills); ``None`` -> as fast as possible."""
    if trigger is None:
        return {"processingTime": "0 seconds"}
    if trigger in ("available_now", "availableNow"):
        return {"availableNow": True}
    if trigger == "once":
        return {"once": True}
    return {"processingTime": trigger}


def kafka_sink_options(bootstrap: str, topic: str, acks: str = "all", compression: str = "lz4",
                       idempotent: bool = True, linger_ms: int = 5, **extra) -> dict[str, str]:
    """Producer settings of a keyed Kafka sink.  Spark's Kafka sink is
    at-least-once; the keyed records make downstream upserts idempotent."""
    opts = {"kafka.bootstrap.servers": bootstrap, "topic": topic, "kafka.acks": acks,
            "kafka.compression.type": compression,
            "kafka.enable.idempotence": str(idempotent).lower(), "kafka.linger.ms": str(linger_ms)}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def keyed_json(df: DataFrame, key: str | None) -> DataFrame:
    """``(key, value)`` rows: the key column and ``to_json(struct(*))``."""
    return encode(df, key)


def _writer(df: DataFrame, checkpoint: str, mode: str, trigger: str | None,
            name: str | None) -> DataStreamWriter:
    w = df.writeStream.option("checkpointLocation", checkpoint).outputMode(mode)
    if name:
        w = w.queryName(name)
    return w.trigger(**trigger_args(trigger))


def start_keyed_json(df: DataFrame, key: str, checkpoint: str, mode: str = "update",
                     trigger: str | None = "5 seconds", path: str | None = None,
                     kafka: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Keyed JSON records to Kafka (``kafka`` = sink options) or, without a
    broker, to JSON files under ``path``.  File sinks only support append:
    other modes go through ``foreachBatch``."""
    rec = keyed_json(df, key)
    if kafka is not None:
        return _writer(rec, checkpoint, mode, trigger, name).format("kafka").options(**kafka).start()
    if mode == "append":
        return _writer(rec, checkpoint, mode, trigger, name).format("json").start(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").json(path)
    return _writer(rec, checkpoint, mode, trigger, name).foreachBatch(write).start()


def start_parquet(df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = (),
                  trigger: str | None = "5 seconds", name: str | None = None) -> StreamingQuery:
    """Append-mode Parquet sink (finalised windows only with a watermark)."""
    w = _writer(df, checkpoint, "append", trigger, name).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    return w.start(path)


def versioned_append(path: str, partition_by: Sequence[str] = ()) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer appending each version with its ``batch_id``.
    A replayed batch rewrites identical rows, which ``latest_version``
    collapses."""
    def write(batch: DataFrame, batch_id: int) -> None:
        w = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(path)
    return write


def upsert_partitions(path: str, keys: Sequence[str], partition_by: Sequence[str],
                      version: str = "batch_id") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer keeping one row per ``keys`` in each partition
    the batch touches: its rows replace stored rows of the same keys (whatever
    their batch id, which restarts with a new checkpoint); other partitions are
    not read or written.  The merged rows are clustered by partition (one file
    per partition and batch: a partition holds one row per window, so this is
    bounded) and staged in a folder of the shared checkpoint folder before the
    overwrite (a path cannot be overwritten while it is read); the folder is
    deleted after it.  Empty batches write nothing.  A stored table
    that cannot be read is an error: only a path that does not exist is the
    first batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        cur = batch.withColumn(version, F.lit(batch_id).cast("long"))
        merged = cur
        if path_exists(spark, path):
            old = spark.read.parquet(path)
            old = _matching(old, cur.select(*partition_by).distinct(), partition_by, "left_semi")
            old = _matching(old, cur, keys, "left_anti")
            merged = old.unionByName(cur.select(*old.columns))
        staged = scratch_path(spark, "upsert")
        merged.write.parquet(staged)
        try:
            (spark.read.schema(merged.schema).parquet(staged).repartition(*partition_by)
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(*partition_by).parquet(path))
        finally:
            delete(spark, staged)
    return write


def _matching(rows: DataFrame, other: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join where a null key equals a null key."""
    twin = other.select(*[F.col(c).alias(f"__o_{c}") for c in on])
    same = F.lit(True)
    for c in on:
        same = same & F.col(c).eqNullSafe(F.col(f"__o_{c}"))
    return rows.join(twin, same, how)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Sub-folders and files of a folder, by name."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(p)) if fs.exists(p) else []


def drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Delete all but the last ``keep`` sub-folders, by name: readers of the
    newest ones are never disturbed."""
    for f in children(spark, path)[:-keep]:
        delete(spark, f)
