import hashlib
import math
import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from citylens.llm import imatch as M


def place(text):
    """Spark's xxhash64 of a text (signed, seed 42)."""
    h = xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def brute(rows):
    """(id, text) in order -> id, n_chars, sha of the edited text."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, place(r[1])))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        h = len(t) // 2
        e = t[: len(t) - h] + nxt[:h]
        out.append((i, t, e, nxt))
    return out


def rows_of(n=300):
    rnd = random.Random(6)
    words = [f"w{i}é" for i in range(400)]
    weights = [1 / (1 + i) for i in range(400)]
    rows = [(rnd.randrange(10**12), " ".join(rnd.choices(words, weights, k=rnd.choice([1, 5, 60, 300])))) for _ in range(n)]
    return rows + [(rows[0][0], rows[0][1]), (rows[1][0], "tie"), (None, "no id here"), (5, None), (6, ""), (7, "同じ 同じ")]


@pytest.mark.parametrize("joined", [False, True])
def test_against_brute_force(spark, monkeypatch, joined):
    rows = rows_of()
    docs = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, n_chars int").repartition(7)
    n, df = len(rows), {}
    for _, t in rows:
        for w in set(re.findall(r"\w+", (t or "").lower())):
            df[w] = df.get(w, 0) + 1
    assert {r["term"]: r["df"] for r in M.document_frequencies(docs).collect()} == df
    band = sorted(w for w, k in df.items() if M.IDF_MIN <= math.log(n / k) <= M.IDF_MAX)
    if joined:
        monkeypatch.setattr(M, "LEXICON_MOST", len(band) - 1)
        assert sorted(r["term"] for r in M.lexicon(docs).collect()) == band
    else:
        assert M.lexicon(docs).names == band

    def over(own):
        return [(M.xxh32_intdigest(b"".join(M.xxh64_intdigest(w).to_bytes(8, "little") for w in s), j) or 1) if (s := [w for w in own if M.xxh64_intdigest(w, 1 + j) < r * 2**64]) else 0
                for j, r in enumerate(M.RATES)]

    def signature(text, full=False):
        """(signatures, whether over all terms)"""
        own = sorted(set(re.findall(r"\w+", text.lower())))
        inside = sorted(set(own) & set(band))
        if not own:
            return [M.xxh32_intdigest(text.encode(), 1000 + j) or 1 for j in range(len(M.RATES))], False
        return (over(own), True) if full or 4 * len(inside) < len(own) else (over(inside), False)

    def alike(x, y):
        (a, p), (b, q) = signature(x), signature(y)
        if p != q:
            a, b = (m if r else (over(sorted(set(re.findall(r"\w+", t.lower()))))) for t, m, r in ((x, a, p), (y, b, q)))
        return float(M.likeness(np.array([a], np.uint32), np.array([b], np.uint32))[0])

    want = [(i, len(t), hashlib.sha256(e.encode()).hexdigest(), M.hexed(np.array([signature(t)[0]], np.uint32))[0],
             M.hexed(np.array([signature(e)[0]], np.uint32))[0], alike(t, e), alike(t, nxt)) for i, t, e, nxt in brute(rows)]
    assert any(signature(t)[1] for _, t in rows if t) and not all(signature(t)[1] for _, t in rows if t)
    got = [tuple(r) for r in M.fingerprint_edits(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert np.mean([r[5] for r in got]) > np.mean([r[6] for r in got])


def test_small_tables(spark):
    one = spark.createDataFrame([(1, "abcdef")], "doc_id long, text string")
    r = M.fingerprint_edits(one).collect()
    assert len(r) == 1 and r[0]["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and r[0]["near_next"] == 1.0 and r[0]["near_edited"] == 0.0
    same = spark.createDataFrame([(1, "x y")] * 5, "doc_id long, text string")
    got = M.fingerprint_edits(same).collect()
    assert len(got) == 5 and {r["near_next"] for r in got} == {1.0} and len({r["fingerprint"] for r in got}) == 1
    assert M.fingerprint_edits(one.limit(0)).count() == 0


def test_near_copies_of_a_text_that_holds_a_third_of_the_rows(spark):
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    hot = rnd.sample([f"h{i}" for i in range(500)], 80)

    def copy():
        return " ".join(x if k != at else f"edit{rnd.randrange(10**6)}" for at in [rnd.randrange(80)] for k, x in enumerate(hot))

    rows = [(i, " ".join(hot)) for i in range(100)] + [(100 + i, copy()) for i in range(50)] + [(200 + i, " ".join(rnd.choices(words, k=80))) for i in range(300)]
    got = {r["doc_id"]: r for r in M.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(got) == len(rows) and len({got[i]["fingerprint"] for i in range(100)}) == 1
    assert all(got[i]["near_next"] == 1.0 for i in range(99)) and all(got[i]["near_edited"] > 0.1 for i in range(99))
    near = [got[i]["near_next"] for i in range(99, 149)]            # one or two words of 80 differ
    assert min(near) > 0.3 and max(near) < 1.0
    assert np.mean([got[i]["near_next"] for i in range(200, 499)]) < 0.2 and got[149]["near_next"] < 0.2 < np.mean(near)


def test_near_copies_of_short_texts_without_lexicon_terms(spark):
    rows = [(i, "please try again") for i in range(200)] + [(200 + i, f"please try again later{i}") for i in range(40)] + [(300 + i, f"a{i} b{i} c{i} d{i}") for i in range(400)]
    got = {r["doc_id"]: r for r in M.fingerprint_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["near_next"] == 1.0 for i in range(199)) and all(0 < got[i]["near_next"] < 1 for i in range(199, 239))
    assert np.mean([got[i]["near_next"] for i in range(300, 699)]) < 0.02


def test_rows_of_one_id_are_spread(spark):
    """Rows without an id, of one id, and the same in all: equal ranges."""
    docs = spark.range(3000).selectExpr("case when id < 1000 then null when id < 2000 then 7L else id end doc_id",
                                        "case when id < 500 then 'same text' else concat('text ', id) end text")
    sizes = [r["n"] for r in M._in_order(docs).selectExpr("spark_partition_id() p").groupBy("p").count().withColumnRenamed("count", "n").collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 3000 and max(sizes) < 2 * 3000 / parts
    got = M.fingerprint_edits(docs).collect()
    assert len(got) == 3000 and sum(r["doc_id"] is None and r["near_next"] == 1.0 for r in got) >= 499
