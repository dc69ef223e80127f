"""Stream sources in the message-bus envelope
``(key, value, topic, partition, offset, timestamp)``.

On a cluster the source is Kafka (``read_kafka``).  Everywhere else -- tests,
replays of archived topics -- a folder of text files (one JSON message per
line) stands in for a topic and is wrapped in the same envelope, so every
downstream operator sees the same columns either way.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(bootstrap: str, topics: str | list[str], starting: str = "latest",
                  max_offsets_per_trigger: int | None = None, **extra: str) -> dict[str, str]:
    """Options of a Kafka source.  ``starting`` is ``latest`` / ``earliest``
    or a JSON offsets spec; ``startingTimestamp`` etc. pass through ``extra``.
    ``max_offsets_per_trigger`` bounds a micro-batch (and so the rows of one
    key a stateful task sees at once).  Expired offsets stop the query, as Spark
    does by default; pass ``failOnDataLoss="false"`` to go on without them."""
    subs = topics if isinstance(topics, str) else ",".join(topics)
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": subs, "startingOffsets": starting}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def read_kafka(spark: SparkSession, bootstrap: str, topics: str | list[str], stream: bool = True,
               **kw) -> DataFrame:
    """Kafka source (needs the spark-sql-kafka connector on the classpath).
    ``stream=False`` reads a bounded range as a batch (replays, backfills:
    ``starting="earliest"`` or ``startingTimestamp=...``, ``endingOffsets``)."""
    opts = kafka_options(bootstrap, topics, **kw)
    if not stream:
        opts.pop("maxOffsetsPerTrigger", None)
        if opts.get("startingOffsets") == "latest":
            opts["startingOffsets"] = "earliest"
        return spark.read.format("kafka").options(**opts).load()
    return spark.readStream.format("kafka").options(**opts).load()


def read_topic_files(spark: SparkSession, path: str, topic: str, stream: bool = True,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder of JSON-lines files as one topic, in the Kafka envelope.

    Each file is a partition of the topic (``partition``: a number from its
    path), and ``offset`` grows with the lines of the file: the place of the
    read block in the file plus the number of the line in the block, so that it
    is the same however the file is split among tasks.  ``key`` is NULL.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"))
    return numbered_lines(raw).select(
        F.lit(None).cast("binary").alias("key"),
        "value",
        F.lit(topic).alias("topic"),
        F.crc32(F.col("file").cast("binary")).bitwiseAND(0x7FFFFFFF).cast("int").alias("partition"),
        "offset",
        F.current_timestamp().alias("timestamp"),
    )


def numbered_lines(raw: DataFrame) -> DataFrame:
    """(value, file, block) rows as read, with their ``offset``.  A line takes
    a byte at least, so the offsets of a block end before the next block."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        at, seen = None, 0
        for b in batches:
            files, blocks = b.column("file").to_pylist(), b.column("block").to_pylist()
            out = np.empty(b.num_rows, np.int64)
            for i, place in enumerate(zip(files, blocks, strict=True)):
                if place != at:
                    at, seen = place, 0
                out[i] = place[1] + seen
                seen += 1
            yield pa.RecordBatch.from_arrays([b.column("value"), b.column("file"), pa.array(out)], names=["value", "file", "offset"])

    return raw.select("value", "file", "block").mapInArrow(run, "value binary, file string, offset long")


def fan_in(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Several topic streams as one, each row tagged with its topic (the
    ``subscribe="a,b,c"`` shape of a Kafka source)."""
    out = None
    for topic, df in frames.items():
        tagged = df.withColumn("topic", F.lit(topic))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def short_topic(col="topic") -> F.Column:
    """``city.bus_gps`` -> ``bus_gps``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^.*\.", "")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def table_stream(spark: SparkSession, sf_dir: str, name: str, schema=None,
                 max_files_per_trigger: int | None = 64) -> DataFrame:
    """A stored table read as a file stream: the folder of a table of many
    part files, or (the stream source takes folders only) a single file picked
    from its parent by name.  At most ``max_files_per_trigger`` files per
    micro-batch, in the order of their modification times -- rules that depend
    on event-time order replay the table with ``Replay``."""
    path = table_path(sf_dir, name)
    if schema is None:
        schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if is_folder(spark, path):
        return r.parquet(path)
    return r.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


#: rows of a table replayed in one micro-batch
REPLAY_ROWS = 2_000_000


class Replay:
    """A stored table replayed as a stream in the order of a column (event time,
    or a number such as an arrival position).

    Part files of a table are in no order, and a watermark (or a per-key clock)
    that has seen a late file discards what an early one holds.  A table of up
    to ``max_rows`` rows in ``max_files`` files is one micro-batch, which needs
    no order.  A larger one is cut into slices of about that size, written once
    into a folder per slice; every ``feed`` adds the next slice to the stream's
    folder, and the query runs over it before the next.  State and watermark
    carry over through the query's checkpoint, so a batch (and with it what a
    keyed operator gets of one key at once) stays bounded and nothing arrives
    late.  Rows without a value in the column come first.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, name: str, ts: str = "ts", max_files: int = 64,
                 max_rows: int = REPLAY_ROWS, least: int = 1):
        from ..session import scratch_path

        self.spark, self.source = spark, table_path(sf_dir, name)
        src = spark.read.parquet(self.source)
        self.slices = max(least, -(-len(src.inputFiles()) // max_files), -(-src.count() // max_rows))
        self.schema = src.schema
        if self.slices <= 1:
            self.slices = 1
            self.stream = table_stream(spark, sf_dir, name, src.schema, None)
            return
        when = F.col(ts).cast("long") if src.schema[ts].dataType.typeName() in ("long", "integer", "short", "byte") else \
            F.unix_micros(F.col(ts).cast("timestamp"))
        cuts = src.select(when.cast("double").alias("t")).approxQuantile(
            "t", [i / self.slices for i in range(1, self.slices)], 0.25 / self.slices)
        part = F.coalesce(sum((F.when(when >= int(c), 1).otherwise(0) for c in sorted(set(cuts))), F.lit(0)), F.lit(0))
        self.slices = len(set(cuts)) + 1
        self.staged, self.live = scratch_path(spark, f"{name}-slices"), scratch_path(spark, f"{name}-live")
        src.withColumn("__slice", part).write.partitionBy("__slice").parquet(self.staged)
        spark.createDataFrame([], self.schema).write.mode("append").parquet(self.live)
        self.stream = spark.readStream.schema(self.schema).parquet(self.live)

    def slice(self, i: int) -> DataFrame:
        """The rows of one step, as a batch."""
        from ..sinks.writers import path_exists

        if self.slices <= 1:
            return self.spark.read.schema(self.schema).parquet(self.source)
        path = f"{self.staged}/__slice={i}"
        return self.spark.read.schema(self.schema).parquet(path) if path_exists(self.spark, path) else self.spark.createDataFrame([], self.schema)

    def feed(self) -> Iterator[int]:
        """Before each step, the stream's folder holds one slice more."""
        from ..sinks.writers import path_exists

        for i in range(self.slices):
            if self.slices > 1 and path_exists(self.spark, f"{self.staged}/__slice={i}"):
                (self.spark.read.schema(self.schema).parquet(f"{self.staged}/__slice={i}")
                 .write.mode("append").parquet(self.live))
            yield i


def event_time(df: DataFrame, col: str = "ts", out: str | None = None) -> DataFrame:
    """Parquet timestamps arrive as TIMESTAMP_NTZ, which watermarks reject;
    reinterpret them as UTC timestamps (session zone is pinned to UTC)."""
    return df.withColumn(out or col, F.col(col).cast("timestamp"))


FLUSH = "__flush"


class Flush:
    """Closes the open windows of a stream that stops.

    An append-mode window is emitted when the watermark has passed its end,
    which takes a later event; at the end of a stream there is none.  The
    stream is read together with a control folder.  ``mark`` puts one row there
    whose time lifts the watermark to the end of the last window that can hold
    an event, and not further: events of later windows are welcome after a
    restart.  ``watermark`` sets the watermark over both and takes the
    marked rows out, so that no aggregate counts them.
    """

    def __init__(self, spark: SparkSession, path: str, ts: str = "timestamp"):
        self.spark, self.path, self.ts = spark, path, ts
        self.schema = f"{ts} timestamp, {FLUSH} boolean"
        if not spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).exists(
                spark._jvm.org.apache.hadoop.fs.Path(path)):
            spark.createDataFrame([], self.schema).write.parquet(path)

    def watermark(self, stream: DataFrame, delay: str) -> DataFrame:
        control = self.spark.readStream.schema(self.schema).parquet(self.path)
        both = stream.withColumn(FLUSH, F.lit(False)).unionByName(control, allowMissingColumns=True).withWatermark(self.ts, delay)
        # Spark pushes a condition below the watermark unless it reads the event
        # time; there it would take the marked row away before it counts.  So
        # this condition does, and so does every column a later one can be on.
        dated = F.col(self.ts) >= F.lit("0001-01-01").cast("timestamp")
        own = [F.col(c) if c == self.ts else F.when(dated, F.col(c)).alias(c) for c in stream.columns]
        return both.where(~F.col(FLUSH) | ~dated).select(*own)

    def mark(self, last_micros: int, every: str, delay: str, slide: str | None = None) -> None:
        """``last_micros``: the latest event time (``last_event_micros``); ``every``, ``slide``: the windows."""
        import datetime as dt

        from ..operators.sequence import micros

        step = micros(slide or every)
        at = last_micros // step * step + micros(every) + micros(delay)
        row = self.spark.createDataFrame([(at, True)], f"t long, {FLUSH} boolean")
        row.select(F.timestamp_micros("t").alias(self.ts), FLUSH).coalesce(1).write.mode("append").parquet(self.path)
        self.marked = dt.datetime.fromtimestamp(at / 1e6, dt.timezone.utc)


def last_event_micros(query, delay: str) -> int | None:
    """The latest event time a query has seen (None: no event yet): of its last
    batches, or from the watermark, which trails all of them by the delay."""
    import datetime as dt

    from ..operators.sequence import micros

    def us(text: str) -> int:
        t = dt.datetime.fromisoformat(text.replace("Z", "+00:00"))
        return round((t - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) / dt.timedelta(microseconds=1))

    seen = []
    for p in query.recentProgress:
        e = p.get("eventTime") or {}
        if e.get("max"):
            seen.append(us(e["max"]))
        if e.get("watermark") and us(e["watermark"]) > 0:
            seen.append(us(e["watermark"]) + micros(delay))
    return max(seen, default=None)
