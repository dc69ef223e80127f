import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from citylens.llm import simhash as S


def brute_fp(text):
    ws, cur = [], ""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or ""))
    for c in low + " ":
        if c == " " or "\t" <= c <= "\r":
            if cur:
                ws.append(cur)
            cur = ""
        else:
            cur += c
    if not ws:
        return 0
    sh = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] or [" ".join(ws)]
    hs = [xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps):
    """fps: list of (id, fp) -> {index: component id}"""
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(fps)):
        groups.setdefault(find(i), []).append(i)
    out = {}
    for g in groups.values():
        ids = [fps[i][0] for i in g if fps[i][0] is not None]
        for i in g:
            out[i] = min(ids) if ids else None
    return out


@pytest.mark.parametrize("text", ["", None, " \t\n", "One", "one TWO", "a b c", "ÀÉ b c d\x0be\x1cf", "x " * 5000, "the cat sat on the mat " * 40])
def test_fingerprint_against_definition(text):
    assert S.simhash(text or "") == brute_fp(text)


def test_near_duplicates_against_brute_force(spark):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [[rnd.choice(words) for _ in range(rnd.randint(1, 400))] for _ in range(60)]
    rows = []
    for i in range(300):
        b = list(rnd.choice(base))
        for _ in range(rnd.randint(0, 2)):
            b[rnd.randrange(len(b))] = rnd.choice(words)
        rows.append((i, " ".join(b)))
    rows += [(400, None), (401, ""), (402, "  "), (403, rows[0][1]), (403, rows[0][1]), (None, rows[5][1]), (None, "lonely words here now")]
    docs = spark.createDataFrame([(a, t, "x", "y") for a, t in rows], "doc_id long, text string, fingerprint string, component_id string")
    got = sorted(map(tuple, S.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    fps = [(a, brute_fp(t)) for a, t in rows]
    comp = brute_components(fps)
    assert got == sorted([(a, f"{fp:016x}", comp[i]) for i, (a, fp) in enumerate(fps)], key=str)
    small = sorted(map(tuple, S.near_duplicates(docs, bucket=2).select("doc_id", "fingerprint", "component_id").collect()), key=str)
    assert small == got                                    # crowded buckets, the same links


def test_links_connect_dense_and_far_fingerprints(spark):
    rng = np.random.default_rng(5)
    centre = rng.integers(0, 2**63, 3)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(24, rng.integers(0, 5), replace=False)) for c in centre for _ in range(120)]
    fps = sorted({int(np.uint64(x).astype(np.int64)) for x in near + rng.integers(0, 2**62, 200).tolist()})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = brute_components([(f, f & (2**64 - 1)) for f in fps])
    from citylens.llm.components import components
    for bucket in (4, 10**6):
        got = {r["node"]: r["root"] for r in components(S.links(df, bucket=bucket)).collect()}
        assert [got.get(f, f) for f in fps] == [want[i] for i in range(len(fps))]
        assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 3 for r in S.links(df, bucket=bucket).collect())


def test_thresholds_spend_every_unit(spark):
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**63, 50)
    df = spark.createDataFrame([(int(f),) for f in fp], "fp long")
    order = S.bit_order(df, 50)
    assert sorted(order.tolist()) == list(range(64))
    tables = S.block_tables(df, order, 3)
    for layout in S.LAYOUTS:
        t, cost = S.thresholds(S.permuted(fp, order), tables, layout, 50, 3)
        assert (t.sum(axis=1) + t.shape[1] == 4).all() and (cost > 0).all()


def test_one_of_each_keeps_columns_ties_and_null_ids(spark):
    text = "one two three four five six seven"
    rows = [(3, text, 1), (1, text, 2), (1, text, 2), (None, text, 3), (None, "other words entirely, quite so", 4), (9, None, 5), (8, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    got = S.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, text, 2), (None, "other words entirely, quite so", 4), (8, "", 6)], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(docs).count() == 0 and S.one_of_each(docs).count() == 0


def test_links_of_crowded_buckets_are_not_broadcast(spark):
    fps = spark.range(300).select(F.xxhash64("id").alias("fp"))
    plan = S._hub_links(fps, 3)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan
