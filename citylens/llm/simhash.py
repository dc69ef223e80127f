"""SimHash near-duplicates: 64-bit fingerprints linked at a bit distance.

Search by the generalised pigeonhole rule.  The 64 bits are put in an order
that groups correlated bits and cut into parts; if a query gives part ``i`` a
threshold ``T_i >= -1`` with ``sum(T_i + 1) = tau + 1``, every fingerprint
within ``tau`` bits is within ``T_i`` bits in some part (-1: part not probed).
Each query has its own thresholds: a dynamic program spends the ``tau + 1``
units where the candidates, estimated from histograms over *all* fingerprints,
cost least.  The query then probes every value within ``T_i`` of its own in the
index of part values and the whole distance is verified.

Defined results: a null text is empty; an empty text has fingerprint zero and
links like any other; rows with equal text share a fingerprint and a component;
a null id keeps its row but is never a component's name unless nothing else is
there; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from ..operators.enrich import bounded_broadcast
from .common import arrow_map, as_signed, keep, pick, release, texts_of, unsigned_hex
from .components import components

TAU = 3
SHINGLE = 3
#: part widths to choose from, in 8-bit blocks
LAYOUTS = ((4, 4), (3, 3, 2), (2, 2, 2, 2))
#: an index bucket with more distinct fingerprints is linked over shared
#: neighbours instead of pair by pair
BUCKET = 512
#: cost of one probe row, in verified candidates
PROBE_COST = 4.0
_CHUNK = 1 << 18


def simhash(text: str, words: int = SHINGLE) -> int:
    """Fingerprint of one text (unsigned)."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z fold, only \x20\x09-\x0D split
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    k = min(words, len(parts))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(parts) - k + 1].tolist()
    n = len(starts)
    hashes = np.fromiter((xxh64_intdigest(line[s:e], 42) for s, e in zip(starts, ends[k - 1:].tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        piece = hashes[at: at + _CHUNK]
        ones += np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed long."""
    def run(batch):
        release()
        fp = np.fromiter((simhash(t, words) for t in texts_of(batch)), np.uint64, batch.num_rows)
        return {"doc_id": batch.column("doc_id"), "fp": as_signed(fp)}

    return arrow_map(pick(docs, doc_id=id_col, text=text_col), run, "doc_id long, fp long")


# ---- statistics over all fingerprints -------------------------------------------------

def _bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _summed(fps: DataFrame, size: int, count) -> np.ndarray:
    """Element-wise sum over the table of ``count(fp array) -> vector``."""
    def run(batches):
        import pyarrow as pa

        total = np.zeros(size)
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(fp), 1 << 16):
                total += count(fp[at: at + (1 << 16)])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], names=["i", "n"])

    out = np.zeros(size)
    for r in fps.select("fp").mapInArrow(run, "i long, n double").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r["i"]] = r["n"]      # at most ``size`` rows, whatever the table
    return out


def bit_order(fps: DataFrame, n: int) -> np.ndarray:
    """The 64 bits, correlated ones next to each other (over all fingerprints)."""
    both = _summed(fps, 64 * 64, lambda fp: (lambda b: (b.T @ b).ravel())(_bits(fp).astype(np.float32))).reshape(64, 64) / max(n, 1)
    p = np.diag(both)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    order = [int(corr.sum(axis=0).argmax())]
    while len(order) < 64:
        near = corr[:, order[-(len(order) % 32 or 32):]].mean(axis=1)      # with the part under construction
        near[order] = -1
        order.append(int(near.argmax()))
    return np.array(order)


def permuted(fp: np.ndarray, order: np.ndarray) -> np.ndarray:
    """(n, 8) blocks: the bits in the given order, 8 to a block."""
    return np.packbits(_bits(fp)[:, order], axis=1, bitorder="little")


_DIST = np.unpackbits(np.bitwise_xor.outer(np.arange(256, dtype=np.uint8), np.arange(256, dtype=np.uint8))[..., None], axis=2).sum(axis=2)


def block_tables(fps: DataFrame, order: np.ndarray, tau: int) -> np.ndarray:
    """[block, value, e]: share of all fingerprints whose block differs from value in e bits."""
    def count(fp):
        blocks = permuted(fp, order).astype(np.int64) + np.arange(8) * 256
        return np.bincount(blocks.ravel(), minlength=2048)

    hist = _summed(fps, 2048, count).reshape(8, 256)
    share = hist / np.maximum(hist.sum(axis=1, keepdims=True), 1)
    return np.stack([np.stack([(_DIST == e) @ share[b] for e in range(tau + 1)], axis=1) for b in range(8)])


def spans_of(layout: tuple[int, ...]) -> list[range]:
    ends = np.cumsum(layout)
    return [range(e - w, e) for e, w in zip(ends.tolist(), layout, strict=True)]


@lru_cache(maxsize=64)
def masks(width: int, t: int) -> np.ndarray:
    """All words of ``width`` bits with at most t ones."""
    out = [0]
    for e in range(1, t + 1):
        out += [sum(1 << i for i in c) for c in combinations(range(width), e)]
    return np.array(out, np.uint64).view(np.int64)


def thresholds(blocks: np.ndarray, tables: np.ndarray, layout, n: int, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Per query the threshold of every part (n, m) and the estimated cost.

    Dynamic program over the parts: ``best[s]`` is the least cost of the parts
    seen so far that have together taken ``s`` of the ``tau + 1`` units.
    """
    q, m, units = len(blocks), len(layout), tau + 1
    cost = np.zeros((m, units + 1, q))                   # [part, units taken]
    for i, part in enumerate(spans_of(layout)):
        share = None                                     # P(part differs in e bits), blocks as independent
        for b in part:
            own = tables[b][blocks[:, b]]
            share = own if share is None else np.stack(
                [sum(share[:, k] * own[:, e - k] for k in range(e + 1)) for e in range(tau + 1)], axis=1)
        for t in range(tau + 1):
            cost[i, t + 1] = PROBE_COST * len(masks(8 * len(part), t)) + n * share[:, : t + 1].sum(axis=1)
    best = np.full((units + 1, q), np.inf)
    best[0] = 0
    took = np.zeros((m, units + 1, q), np.int8)
    for i in range(m):
        new = np.full_like(best, np.inf)
        for s in range(units + 1):
            for u in range(s + 1):
                c = best[s - u] + cost[i, u]
                better = c < new[s]
                new[s] = np.where(better, c, new[s])
                took[i, s] = np.where(better, u, took[i, s])
        best = new
    out, left = np.zeros((q, m), np.int64), np.full(q, units)
    for i in reversed(range(m)):
        u = took[i, left, np.arange(q)]
        out[:, i] = u.astype(np.int64) - 1
        left = left - u
    return out, best[units]


def part_values(blocks: np.ndarray, part: range) -> np.ndarray:
    return sum(blocks[:, b].astype(np.int64) << (8 * k) for k, b in enumerate(part))


def choose_layout(tables: np.ndarray, n: int, tau: int, layouts=LAYOUTS):
    """The layout whose thresholds cost least on blocks drawn at random from the histograms."""
    rng = np.random.default_rng(7)
    share = tables[:, :, 0]
    drawn = np.stack([rng.choice(256, 2000, p=s / s.sum()) if s.sum() else np.zeros(2000, int) for s in share], axis=1)
    return min(layouts, key=lambda x: thresholds(drawn, tables, x, n, tau)[1].mean())


# ---- links ------------------------------------------------------------------------------

def _hub_links(fps: DataFrame, tau: int) -> DataFrame:
    """Links that connect all of ``fps`` within ``tau`` bits, without pairs.

    Two fingerprints at tau bits meet in a value at most ``near = tau // 2``
    bits from one and ``tau - near`` from the other.  All that come within
    ``near`` of a value are linked to the least of them (at most 2 * near bits
    away), those within ``tau - near`` as well (at most tau bits): the number of
    rows is a constant times the fingerprints, however dense they lie.
    """
    near = tau // 2
    inner, outer = masks(64, near), masks(64, tau - near)
    outer = outer[len(inner):]

    def around(shape):
        def run(batch):
            fp = batch.column(0).to_numpy(zero_copy_only=False)
            return {"hub": (fp[:, None] ^ shape[None, :]).ravel(), "fp": np.repeat(fp, len(shape))}
        return run

    # few rows to an Arrow batch: each becomes up to 2,016
    parts = fps.select("fp").repartition(fps.sparkSession.sparkContext.defaultParallelism * 4, "fp")

    def spread(shape):
        def run(batches):
            import pyarrow as pa

            one = around(shape)
            for b in batches:
                for at in range(0, b.num_rows, 256):
                    got = one(b.slice(at, 256))
                    yield pa.RecordBatch.from_arrays([pa.array(got["hub"]), pa.array(got["fp"])], names=["hub", "fp"])
        return parts.mapInArrow(run, "hub long, fp long")

    close = spread(inner)
    anchors = close.groupBy("hub").agg(F.min("fp").alias("anchor"))
    rows = close.unionByName(spread(outer)) if len(outer) else close
    # the planner takes each side for as small as ``fps`` and would send 2,000 times that through the driver
    return (rows.hint("merge").join(anchors.hint("merge"), "hub").where("fp <> anchor")
            .select(F.col("fp").alias("a"), F.col("anchor").alias("b")).distinct())


def links(fps: DataFrame, tau: int = TAU, bucket: int = BUCKET, layouts=LAYOUTS) -> DataFrame:
    """Links (a, b) of a table of distinct fingerprints (column fp): their
    components are those of *all* pairs within ``tau`` bits, and every link is
    one.  Pairs meeting only in crowded buckets are replaced by links over a
    shared neighbour."""
    n = fps.count()
    order = bit_order(fps, n)
    tables = block_tables(fps, order, tau)
    layout = choose_layout(tables, n, tau, layouts)
    parts = spans_of(layout)

    def index(batch):
        fp = batch.column(0).to_numpy(zero_copy_only=False)
        blocks = permuted(fp, order)
        return {"key": np.concatenate([part_values(blocks, p) | (i << 32) for i, p in enumerate(parts)]),
                "x": np.tile(fp, len(parts))}

    def probe(batches):
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 2048):
                fp = b.column(0).slice(at, 2048).to_numpy(zero_copy_only=False)
                blocks = permuted(fp, order)
                t, _ = thresholds(blocks, tables, layout, n, tau)
                for i, p in enumerate(parts):
                    value = part_values(blocks, p)
                    for level in range(tau + 1):
                        at_level = t[:, i] == level
                        if at_level.any():
                            m = masks(8 * len(p), level)
                            key = (value[at_level][:, None] ^ m[None, :]).ravel() | (i << 32)
                            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(fp[at_level], len(m)))], names=["key", "q"])

    only = fps.select("fp")
    idx = arrow_map(only, index, "key long, x long")
    probes = only.mapInArrow(probe, "key long, q long")
    hot = keep(idx.groupBy("key").count().where(F.col("count") > bucket).select("key"), "crowded")
    crowded = not hot.isEmpty()
    if crowded:
        idx = idx.join(hot, "key", "left_anti")
    found = probes.join(idx, (probes["key"] == idx["key"]) & (F.col("q") < F.col("x"))
                        & (F.bit_count(F.col("q").bitwiseXOR(F.col("x"))) <= tau)).select(
        F.col("q").alias("a"), F.col("x").alias("b"))
    if not crowded:
        return found.distinct()
    # a pair that met in a crowded bucket only: its query probed the bucket, its other end lies in it
    whole = arrow_map(only, index, "key long, x long")
    near = (probes.join(hot, "key", "left_semi").select(F.col("q").alias("fp"))
            .unionByName(whole.join(hot, "key", "left_semi").select(F.col("x").alias("fp")))).distinct()
    return found.unionByName(_hub_links(keep(near, "dense"), tau)).distinct()


def near_duplicates(docs: DataFrame, tau: int = TAU, words: int = SHINGLE, id_col: str = "doc_id",
                    text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fingerprint, component_id, fp): component_id is the smallest id
    reachable over links of at most ``tau`` bits, itself included (null only if
    every id in the component is)."""
    fps = keep(fingerprints(docs, words, id_col, text_col), "simhash")
    distinct = keep(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = components(links(distinct, tau, bucket))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    name = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    # written, so that both sides of the last join are plain scans: a fingerprint shared by a third of all rows can be split there
    of_fp = keep(named.select("fp", "root").join(name, "root").select("fp", F.col("root").alias("component_fp"), "component_id"), "components")
    return fps.join(of_fp, "fp").select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id", "component_fp")


def one_of_each(docs: DataFrame, tau: int = TAU, words: int = SHINGLE, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one of the smallest id
    (rows without id come last; of rows with the same id, the one of the least
    row hash; of equal rows, one).  All columns are kept."""
    cols = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    pos = {c: f"_c{i}" for i, c in reversed(list(enumerate(cols)))}
    row = flat.withColumn("_row", F.xxhash64(*[F.to_json(F.struct(c)) if t.startswith("map") else F.col(c) for c, t in flat.dtypes]))
    ids, texts = pos[id_col], pos[text_col]
    key = row.select(F.struct(F.col(ids).isNull().alias("none"), F.col(ids).alias("id"), F.col("_row").alias("row")).alias("key"), F.col(texts).alias("text"))

    def run(batch):
        release()
        fp = np.fromiter((simhash(t, words) for t in texts_of(batch)), np.uint64, batch.num_rows)
        return {"none": batch.column("none"), "id": batch.column("id"), "row": batch.column("row"), "fp": as_signed(fp)}

    fps = keep(arrow_map(key.select("key.*", "text"), run, "none boolean, id long, row long, fp long"), "simhash")
    distinct = keep(fps.groupBy("fp").agg(F.min(F.struct("none", "id", "row")).alias("first")), "distinct")
    roots = components(links(distinct, tau))
    first = (distinct.join(roots, distinct["fp"] == roots["node"], "left")
             .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")))
    chosen = keep(first.select(F.col("first.id").alias("k_id"), F.col("first.row").alias("k_row")), "chosen")
    # what goes is a small part of the rows: they are looked up in it, and only shuffled if it is large
    gone = keep(fps.join(chosen, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("row") == F.col("k_row")), "left_anti")
                .select(F.col("id").alias("g_id"), F.col("row").alias("g_row")).distinct(), "gone")
    kept = row.join(bounded_broadcast(gone), F.col(ids).eqNullSafe(F.col("g_id")) & (F.col("_row") == F.col("g_row")), "left_anti")
    twice = (fps.join(chosen, F.col("id").eqNullSafe(F.col("k_id")) & (F.col("row") == F.col("k_row")), "left_semi")
             .groupBy("id", "row").count().where("count > 1"))
    if not twice.isEmpty():
        kept = kept.dropDuplicates([ids, "_row"])
    return kept.drop("_row").toDF(*cols)
