"""Token counts as delta-maintained rollups.

Totals per source, language and tokenizer version are additive, so they are
kept as a log of signed sums: an insert adds a document and its tokens, a delete
takes them away, a revision takes the old count away and adds the new one.  A
batch is summed before it is written (map-side first, so a source with a third
of all rows shrinks to a row per task) and stored under its id; it counts from
the moment Spark's writer puts its ``_SUCCESS`` mark.  Committing an id again
changes nothing, and a batch that broke off is written over: replays after a
lost driver or executor are safe.  ``compact`` folds committed batches into one
snapshot, adds their ids to the snapshot's table of ids and deletes what is folded:
the driver sees the batches since the last snapshot, never all ids.

Defined results: a null source, language or version is a key of its own; null
counts are 0; an event of unknown kind is an error; totals of no documents and
no tokens are left out; an empty batch is committed like any other; further
columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, pick, texts_of
from .tokens import encoder, vocabulary

KEYS = ("source", "lang", "tokenizer")
_SUMS = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def token_counts(docs: DataFrame, tokenizers: dict[str, str], id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                 lang_col: str = "lang") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens, text_key), a row for each
    document and tokenizer version; ``tokenizers``: version -> vocabulary file.
    text_key is equal for equal texts."""
    own = pick(docs, doc_id=id_col, text=text_col, source=source_col, lang=lang_col)
    own = own.withColumn("text_key", F.md5(F.coalesce(F.col("text"), F.lit(""))))
    ranks = {v: own.sparkSession.sparkContext.broadcast(vocabulary(path)) for v, path in tokenizers.items()}

    def run(batch):
        texts, k = texts_of(batch), len(ranks)
        counts = [np.fromiter(map(len, encoder(v, r, k).batch(texts)), np.int64, len(texts)) for v, r in ranks.items()]
        out = {c: [x for x in batch.column(c).to_pylist() for _ in range(k)] for c in ("doc_id", "source", "lang", "text_key")}
        return out | {"tokenizer": list(ranks) * len(texts), "tokens": np.stack(counts, axis=1).ravel() if k else []}

    return arrow_map(own, run, "doc_id long, source string, lang string, tokenizer string, tokens long, text_key string")


def signed(events: DataFrame) -> DataFrame:
    """Events (op, source, lang, tokenizer, tokens and, for revisions, the
    same with ``old_`` in front) as signed rows."""
    own = pick(events, op="op", **{c: c for c in (*KEYS, "tokens")}, **{f"old_{c}": f"old_{c}" for c in (*KEYS, "tokens")})

    def part(prefix: str, sign: int | Column) -> Column:
        return F.struct(*[F.col(prefix + c).alias(c) for c in KEYS], F.lit(sign).cast("long").alias("n_docs"),
                        (F.coalesce(F.col(prefix + "tokens"), F.lit(0)) * sign).cast("long").alias("n_tokens"))

    rows = (F.when(F.col("op") == "insert", F.array(part("", 1)))
            .when(F.col("op") == "delete", F.array(part("", -1)))
            .when(F.col("op") == "revise", F.array(part("old_", -1), part("", 1)))
            .otherwise(F.raise_error(F.concat(F.lit("no such kind of event: "), F.coalesce("op", F.lit("null"))))))
    return own.select(F.explode(rows).alias("r")).select("r.*")


def summed(rows: DataFrame) -> DataFrame:
    """Additive totals per key (also of totals); keys that come to nothing are left out."""
    return (rows.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            .where("n_docs <> 0 or n_tokens <> 0"))


class Rollup:
    """The stored rollup under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _committed(self, kind: str) -> list[str]:
        root = self._path(f"{self.path}/{kind}")
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        return sorted(n.removeprefix("id=") for n in names if self._fs.exists(self._path(f"{self.path}/{kind}/{n}/_SUCCESS")))

    def _snapshot(self) -> str | None:
        """Folder of the latest snapshot (``sums`` and ``ids``; done when the sums are written)."""
        root = self._path(f"{self.path}/snapshots")
        names = sorted((x.getPath().getName() for x in self._fs.listStatus(root)), reverse=True) if self._fs.exists(root) else []
        done = (f"{self.path}/snapshots/{n}" for n in names if self._fs.exists(self._path(f"{self.path}/snapshots/{n}/sums/_SUCCESS")))
        return next(done, None)

    def _ids(self, snapshot: str | None) -> DataFrame:
        return self.spark.read.schema("id string").parquet(f"{snapshot}/ids") if snapshot else self.spark.createDataFrame([], "id string")

    def _beside(self, snapshot: str | None) -> list[str]:
        """Committed batches that the snapshot does not hold (those it holds are
        deleted, but for a compaction that broke off)."""
        found = self._committed("batches")
        held = {r["id"] for r in self._ids(snapshot).where(F.col("id").isin(found)).collect()} if snapshot and found else set()
        return [b for b in found if b not in held]

    def batches(self) -> DataFrame:
        """(id) of all committed batches."""
        snapshot = self._snapshot()
        return self._ids(snapshot).unionByName(self.spark.createDataFrame([(b,) for b in self._beside(snapshot)], "id string"))

    def commit(self, batch_id: str, rows: DataFrame) -> bool:
        """Adds a batch of signed rows; False if the id has been committed before."""
        if not batch_id or "/" in batch_id or batch_id.startswith((".", "_")):
            raise ValueError(f"no batch id: {batch_id!r}")
        snapshot = self._snapshot()
        if batch_id in self._committed("batches") or not self._ids(snapshot).where(F.col("id") == batch_id).isEmpty():
            return False
        summed(rows).write.mode("overwrite").parquet(f"{self.path}/batches/id={batch_id}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, tokenizer, n_docs, n_tokens) over all committed batches."""
        snapshot = self._snapshot()
        beside = self._beside(snapshot)
        parts = [] if snapshot is None else [self.spark.read.schema(_SUMS).parquet(f"{snapshot}/sums")]
        if beside:
            parts.append(self.spark.read.schema(_SUMS).parquet(*[f"{self.path}/batches/id={b}" for b in beside]))
        out = parts[0] if parts else self.spark.createDataFrame([], _SUMS)
        for p in parts[1:]:
            out = out.unionByName(p)
        return summed(out)

    def compact(self) -> None:
        """Folds all committed batches into a new snapshot and deletes them, and
        all snapshots but the one before (totals that are being read come from it)."""
        old = self._snapshot()
        beside = self._beside(old)
        number = int(old.rsplit("/", 1)[1]) + 1 if old else 1
        new = f"{self.path}/snapshots/{number:012d}"
        self.batches().write.mode("overwrite").parquet(f"{new}/ids")
        self.totals().write.mode("overwrite").parquet(f"{new}/sums")
        for b in beside:
            self._fs.delete(self._path(f"{self.path}/batches/id={b}"), True)
        for x in self._fs.listStatus(self._path(f"{self.path}/snapshots")):
            if int(x.getPath().getName()) < number - 1:
                self._fs.delete(x.getPath(), True)
