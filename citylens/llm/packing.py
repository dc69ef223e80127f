"""Best-two-fit packing of token sequences.

A document is its token ids and a closing id 0; one longer than a sequence is
cut into full pieces, the first of which may be shorter.  Bins are planned on
the histogram of piece lengths -- at most one number per possible length, so
the plan is global yet bounded -- and pieces find their bin by the rank of the
piece among those of its length.  A task numbers its own pieces of each length as
it cuts them; a prefix sum over the counts of (length, task) makes these ranks
global.  So no group of rows is sorted or gathered, however many share a length,
an id or a text.

Plan, over counts: open a bin with the longest piece left, add the longest that
still fits, again and again; if a gap remains, take the bin's smallest piece
out and look for two unpacked pieces that fill the widened gap better.  The
same bin is made as often as the counts allow, so the number of different bins
stays in the order of the number of lengths.

Defined results: a null text is empty and one token long; repeated rows are
packed each; a null id is kept; an empty table gives no pieces; further
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import arrow_map, keep, pick, slices, texts_of
from .tokens import added_tokens, encoder, vocabulary

SIZE = 2048
END = b"\0\0\0\0"
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def cut(tokens: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of that many tokens."""
    if tokens <= size:
        return [(0, tokens)]
    head = tokens % size
    return ([(0, head)] if head else []) + [(s, size) for s in range(head, tokens, size)]


def pieces(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """One row per piece with the CRC-32 of its ids (unsigned, little-endian 32-bit),
    the task that cut it and its number (from 0) among that task's of its length."""
    ranks, added = docs.sparkSession.sparkContext.broadcast(vocabulary(tokenizer)), added_tokens(tokenizer)
    target = to_arrow_schema(_parse_datatype_string(_PIECES))

    def run(batches):
        task, so_far = TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in slices(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder(str(tokenizer), ranks, added=added).batch(texts_of(batch)), strict=True):
                ids = ids.astype("<u4").tobytes() + END
                for k, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    rows.append((doc_id, k, start, length, zlib.crc32(ids[4 * start: 4 * (start + length)]), task, so_far[length]))
                    so_far[length] += 1
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), target.types, strict=True)], schema=target)

    return pick(docs, doc_id=id_col, text=text_col).mapInArrow(run, _PIECES)


def plan_bins(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[int]]]:
    """[(how many bins, the lengths in each)]; every piece is in one bin."""
    left = np.zeros(size + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out = []
    lengths = [int(x) for x in np.flatnonzero(left)]           # ascending, those with pieces left

    def longest(limit: int, taken: Counter) -> int:
        """The longest unpacked length up to limit, or 0."""
        i = bisect_right(lengths, limit) - 1
        while i >= 0 and left[lengths[i]] <= taken[lengths[i]]:
            i -= 1
        return lengths[i] if i >= 0 else 0

    while lengths:
        taken: Counter = Counter()
        gap, held = size, []
        while gap and (add := longest(gap, taken)):
            held.append(add)
            taken[add] += 1
            gap -= add
        if gap and len(held) > 1:
            small = held[-1]                                   # the smallest: added last
            taken[small] -= 1
            room, best = gap + small, (small,)
            for i in range(bisect_right(lengths, room - 1) - 1, -1, -1):
                a = lengths[i]
                if 2 * a <= sum(best):
                    break                                      # a is the longer of the two
                if left[a] <= taken[a]:
                    continue
                taken[a] += 1
                b = longest(min(a, room - a), taken)
                taken[a] -= 1
                if b and a + b > sum(best):
                    best = (a, b)
                    if a + b == room:
                        break
            held[-1:] = best
            taken.update(best)
        need = Counter(held)
        times = min(int(left[x]) // k for x, k in need.items())
        for x, k in need.items():
            left[x] -= times * k
            if not left[x]:
                lengths.remove(x)
        out.append((times, held))
    return out


def places(plan: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """The plan as runs: ranks [rank, ...) of a length go to bins from ``bin``
    on, ``each`` to a bin, from offset ``at``.  Sorted by (length, rank)."""
    used: Counter = Counter()
    rows, first = [], 0
    for times, held in plan:
        at = 0
        for length, each in sorted(Counter(held).items(), reverse=True):
            rows.append((length, used[length], first, each, at))
            used[length] += times * each
            at += length * each
        first += times
    rows.sort()
    return dict(zip(("length", "rank", "bin", "each", "at"), np.array(rows, np.int64).reshape(-1, 5).T, strict=True))


def pack(parts: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (``pieces``, written)."""
    cells = keep(parts.groupBy("length", "task").agg(F.count("*").alias("n")), "cells")
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}    # a row per length
    runs = places(plan_bins(counts, size))
    key = runs["length"] << 44 | runs["rank"]
    shared = parts.sparkSession.sparkContext.broadcast((key, runs))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)     # a row per task
    offsets = cells.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = parts.join(offsets, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("nth") + F.col("before")).alias("rank"))

    def run(batch):
        keys, at = shared.value
        length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
        i = np.searchsorted(keys, length << 44 | rank, side="right") - 1
        nth = rank - at["rank"][i]
        out = {c: batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")}
        return out | {"sequence_id": at["bin"][i] + nth // at["each"][i], "offset": at["at"][i] + nth % at["each"][i] * length}

    return arrow_map(ranked, run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_two_fit(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Packs all of ``docs``: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(keep(pieces(docs, size, tokenizer, id_col, text_col), "pieces"), size)
