"""Connected components of a link table, by alternating stars.

Nodes are longs.  Every round replaces a link by one to the smallest known
neighbour ("large star", then "small star"); rows never grow beyond the number
of links, nothing is gathered per node (``min`` combines map-side, the joins
are plain equi-joins that AQE may split), and every round is a written table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .common import drop_kept, keep

_LINK = "a long, b long"
#: links of a file that a round writes, about
_FILE_ROWS = 1 << 20


def _local_forest(batches):
    """Spanning stars of the links in each Arrow batch: same components, fewer rows."""
    for batch in batches:
        a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(a):
            continue
        nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = flat[: len(a)], flat[len(a):]
        parent = np.arange(len(nodes))
        while True:
            low = np.minimum(parent[x], parent[y])
            before = parent.copy()
            np.minimum.at(parent, parent[x], low)
            np.minimum.at(parent, parent[y], low)
            parent = parent[parent]
            if np.array_equal(before, parent):
                break
        moved = parent != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[parent[moved]])], names=["a", "b"])


def _star(links: DataFrame, small: bool) -> DataFrame:
    """One star step over links with a > b (each known once)."""
    both = links if small else links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
    j = both.join(low, F.col("a") == F.col("k"))
    if small:       # every smaller neighbour, and the node itself, under the smallest
        moved = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            low.select(F.col("k").alias("a"), F.col("m").alias("b")))
    else:           # every larger neighbour under the smallest
        moved = j.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in ``links`` (two long columns
    a, b; rows with a null or a = b give nothing); root is the smallest node of the component.
    Repeated and mirrored links are fine; an empty table gives an empty one."""
    pairs = links.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    def written(df):
        """The table, and its number of rows and a sum over them, counted by the job that writes it."""
        seen = Observation()
        out = keep(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")), "cc")
        return out, (seen.get["n"], seen.get["s"])

    now, seen = written(pairs.mapInArrow(_local_forest, _LINK).distinct())
    while seen[0]:
        # a round has no more rows than the one before: a small one in few files
        step = _star(_star(now, small=False), small=True)
        nxt, got = written(step.coalesce(1 + seen[0] // _FILE_ROWS))
        drop_kept(now)
        now = nxt
        if got == seen:
            break
        seen = got
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
