"""Helpers shared by the text operators: column picking, written tables, ids."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """``pick(df, id="doc_id", text="text")``: only those columns, renamed.

    Chosen by position, so further columns whose names differ in case alone
    (or repeat) do not clash; an exact name wins over another spelling.
    """
    names = df.columns
    places = []
    for want in cols.values():
        exact = [i for i, n in enumerate(names) if n == want]
        close = [i for i, n in enumerate(names) if n.lower() == want.lower()]
        if not exact and not close:
            raise ValueError(f"no column {want!r} among {names}")
        places.append((exact or close)[0])
    flat = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return flat.select(*[F.col(f"_c{i}").alias(out) for out, i in zip(cols, places, strict=True)])


def keep(df: DataFrame, name: str, tidy: bool = False) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and later uses do not recompute.
    With ``tidy`` the shuffle files of the write are deleted when it is done."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    try:
        if tidy:
            spark.conf.set(setting, "true")
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)
    return spark.read.schema(df.schema).parquet(path)


def drop_kept(df: DataFrame) -> None:
    """Delete the files of a table made by ``keep`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(f)
        p.getFileSystem(conf).delete(p, True)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of an Arrow batch; null counts as empty."""
    return [t or "" for t in batch.column(name).to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most so many rows: a worker then holds what it
    makes of a slice only, whatever rows come together."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def arrow_map(df: DataFrame, fn, schema: str, rows: int | None = None) -> DataFrame:
    """``mapInArrow`` where ``fn(batch)`` gives a dict of column -> values (or
    None for nothing); the schema's types are applied here.  With ``rows`` the
    batches come in slices of at most so many."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, rows) if rows else batches:
            out = fn(b)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type)
                     for f in target], schema=target)
        give_back()

    return df.mapInArrow(run, schema)


def unsigned_hex(col):
    """16 lowercase hex digits of a long read as unsigned."""
    return F.lower(F.lpad(F.hex(col), 16, "0"))


def as_signed(x: np.ndarray) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64).view(np.int64)


_HELD: dict[str, object] = {}
_USE = [""]


def held(use: str, name: str, make):
    """What a Python worker keeps between batches and tasks, made once.  Workers
    outlive an operator, so only what belongs to the use at hand is kept:
    another use drops it first."""
    if use != _USE[0]:
        release(use)
    if name not in _HELD:
        _HELD[name] = make()
    return _HELD[name]


def release(use: str = "") -> None:
    """Drop what the worker keeps of other uses."""
    if use != _USE[0]:
        _HELD.clear()
        _USE[0] = use
        gc.collect()
        give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker waits for its next task
    with all that its allocators keep, beside the others of its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # of the GNU library only
    if trim is not None:
        trim(0)
