"""A folder table whose batches are committed by a ledger.

Files are written first, under ``data/commit=<name>``; a batch becomes part of the
table when its ledger entry appears (one small file, made by an atomic rename
that fails if the number is taken).  So

* a batch that was written half is not in the table,
* a batch that is replayed after a restart finds itself in the ledger and does
  nothing, in every sink that has a table of its own,
* ``compact`` replaces small files by larger ones in one entry: a reader sees the old
  file set or the new one, and the old files stay until ``vacuum`` has
  let some more commits pass.

The ledger is folded into one entry from time to time; it holds the names of
the live files and the last batch of each query, whatever the number of batches.
On an object store without atomic rename there must be one writer per table.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ledger entries after which they are folded into one
FOLD = 50
#: size that compaction packs files up to
TARGET_BYTES = 128 << 20


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = (), fmt: str = "parquet"):
        self.spark, self.path, self.schema, self.partition_by, self.fmt = spark, path.rstrip("/"), schema, list(partition_by), fmt
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.path).getFileSystem(self._conf)
        for folder in ("data", "ledger"):
            self._fs.mkdirs(self._path(f"{self.path}/{folder}"))

    # ---- ledger -------------------------------------------------------------------------
    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def _entries(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/ledger"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _read(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.path}/ledger/{number:020d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _state(self) -> tuple[int, dict, dict, dict, int]:
        """(last number, live file -> bytes, query -> last batch, dropped file -> number, entries read)."""
        numbers, read = self._entries(), []
        for n in reversed(numbers):                     # back to the last folded entry
            read.append((n, self._read(n)))
            if read[-1][1].get("folded"):
                break
        live, done, gone = {}, {}, {}
        for n, e in reversed(read):
            live.update(e["add"])
            for f in e["drop"]:
                live.pop(f, None)
                gone[f] = e["drop"][f] or n
            done.update(e["done"])
        return (numbers[-1] if numbers else 0), live, done, gone, len(read)

    def _publish(self, number: int, entry: dict) -> bool:
        """Make ledger entry ``number``; False if it is there already."""
        tmp, final = (self._path(f"{self.path}/ledger/{n}") for n in (f".{uuid4().hex}.tmp", f"{number:020d}.json"))
        out = self._fs.create(tmp, False)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            context.rename(self._fs.makeQualified(tmp), self._fs.makeQualified(final), plain)
            return True
        except Exception as e:  # noqa: BLE001 - py4j wraps the Java error
            self._fs.delete(tmp, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise

    def _commit(self, add: dict, drop: Sequence[str], query: str | None = None, batch: int | None = None) -> bool:
        while True:
            last, live, done, _, _ = self._state()
            if query is not None and done.get(query, -1) >= batch:
                return False
            if any(f not in live for f in drop):
                return False                            # another writer has replaced these files
            if self._publish(last + 1, {"add": add, "drop": dict.fromkeys(drop), "done": {} if query is None else {query: batch}}):
                self._fold()
                return True

    def _fold(self) -> None:
        last, live, done, gone, n = self._state()
        if n >= FOLD and self._publish(last + 1, {"folded": True, "add": live, "drop": gone, "done": done}):
            for old in self._entries():
                if old <= last:
                    self._fs.delete(self._path(f"{self.path}/ledger/{old:020d}.json"), False)

    # ---- batches --------------------------------------------------------------------------
    def done(self, query: str, batch: int) -> bool:
        return self._state()[2].get(query, -1) >= batch

    def _write(self, df: DataFrame, name: str) -> dict:
        """Write a file set; relative names and sizes."""
        folder = f"{self.path}/data/commit={name}"
        w = df.write.mode("overwrite")
        if self.partition_by:
            w = w.partitionBy(*self.partition_by)
        w.format(self.fmt).save(folder)
        files, root = {}, self._fs.makeQualified(self._path(f"{self.path}/data")).toString() + "/"
        it = self._fs.listFiles(self._path(folder), True)
        while it.hasNext():
            s = it.next()
            if not s.getPath().getName().startswith(("_", ".")):
                files[s.getPath().toString().removeprefix(root)] = s.getLen()
        return files

    def append(self, df: DataFrame, query: str, batch: int) -> bool:
        """Add a micro-batch; False (and nothing done) if it is in the table.
        Rows are clustered by partition: a partition gets one file a batch."""
        if self.done(query, batch):
            return False
        if self.partition_by:
            df = df.repartition(*self.partition_by)
        return self._commit(self._write(df, f"{query}-{batch:012d}-{uuid4().hex[:8]}"), [], query, batch)

    def files(self) -> dict[str, int]:
        return self._state()[1]

    def read(self) -> DataFrame:
        return self._load(sorted(self.files()))

    def _load(self, files: Sequence[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.schema)
        data = f"{self.path}/data"
        got = self.spark.read.schema(self.schema).option("basePath", data).format(self.fmt).load([f"{data}/{f}" for f in files])
        return got.select(*self.schema.fieldNames())

    # ---- small files ------------------------------------------------------------------------
    def plan(self, target: int = TARGET_BYTES) -> list[list[str]]:
        """Groups of files to merge: per partition, files under half the target
        packed into bins of at most the target, the largest first, each into
        the fullest bin that takes it."""
        parts = defaultdict(list)
        for f, size in self.files().items():
            if size < target // 2:
                parts["/".join(f.split("/")[1:-1])].append((size, f))
        out = []
        for _, files in sorted(parts.items()):
            bins: list[tuple[int, list[str]]] = []
            for size, f in sorted(files, reverse=True):
                fits = [b for b in range(len(bins)) if bins[b][0] + size <= target]
                if fits:
                    b = max(fits, key=lambda b: bins[b][0])
                    bins[b] = (bins[b][0] + size, [*bins[b][1], f])
                else:
                    bins.append((size, [f]))
            out += [b for _, b in bins if len(b) > 1]
        return out

    def compact(self, target: int = TARGET_BYTES) -> int:
        """Merge small files; the number of files that went."""
        bins = self.plan(target)
        if not bins:
            return 0
        old = [f for b in bins for f in b]
        number = self.spark.createDataFrame([(f, i) for i, b in enumerate(bins) for f in b], "__file string, __bin int")
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").format(self.fmt).load(
            [f"{self.path}/data/{f}" for f in old])
        # the path as the ledger has it: Spark shows it percent-encoded
        shown = F.element_at(F.split("_metadata.file_path", "/data/commit="), -1)
        named = rows.withColumn("__file", F.concat(F.lit("commit="), F.url_decode(F.regexp_replace(shown, r"\+", "%2B"))))
        merged = named.join(number, "__file").repartition(len(bins), "__bin").select(*self.schema.fieldNames())
        new = self._write(merged, f"compact-{uuid4().hex[:8]}")
        return len(old) - len(new) if self._commit(new, old) else 0

    def rewrite(self, change: Callable[[DataFrame], DataFrame]) -> int:
        """Replace all rows by ``change`` of them in one commit (what is
        appended meanwhile stays); the number of files that went."""
        old = sorted(self.files())
        if not old:
            return 0
        new = self._write(change(self._load(old)).select(*self.schema.fieldNames()), f"rewrite-{uuid4().hex[:8]}")
        return len(old) - len(new) if self._commit(new, old) else 0

    def vacuum(self, keep: int = 10) -> int:
        """Delete files that were replaced at least ``keep`` commits ago; a
        reader that started before then has long opened its files."""
        last, live, done, gone, _ = self._state()
        old = [f for f, n in gone.items() if n <= last - keep]
        for f in old:
            self._fs.delete(self._path(f"{self.path}/data/{f}"), False)
        if old and self._publish(last + 1, {"folded": True, "add": live, "done": done, "drop": {f: n for f, n in gone.items() if f not in set(old)}}):
            for n in self._entries():
                if n <= last:
                    self._fs.delete(self._path(f"{self.path}/ledger/{n:020d}.json"), False)
        return len(old)


Shape = Callable[[DataFrame, int], DataFrame]


def into_tables(query: str, tables: Mapping[str, tuple[CommittedTable, Shape]]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer of one query (one state) into several tables: the
    batch is computed once, each table takes its shape of it, and a replayed
    batch is written only where it is missing."""
    def write(batch: DataFrame, batch_id: int) -> None:
        missing = [(t, shape) for t, shape in tables.values() if not t.done(query, batch_id)]
        if not missing:
            return
        batch = batch.persist()
        try:
            for t, shape in missing:
                t.append(shape(batch, batch_id), query, batch_id)
        finally:
            batch.unpersist()
    return write
