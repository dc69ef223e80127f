import hashlib
import random
import zlib

import numpy as np
import pytest

from citylens.llm import periodic as P


def brute_runs(words, least=6, power=4):
    """Every period by itself: maximal stretches of equal words q apart."""
    n, out = len(words), {}
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, power * q):
                out.setdefault((i, j - i + q), q)       # the smallest period comes first
            i = j + 1
    return sorted(((a, m, q) for (a, m), q in out.items()), key=lambda r: (r[0], r[2]))


def brute_words(text):
    out, cur = [], ""
    for c in (text or "") + " ":
        if c == " " or "\t" <= c <= "\r":
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += c
    return out


def brute(doc_id, text):
    """The contract's row of one document."""
    words = brute_words(text)
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join(f"{a},{m},{q}\n" for a, m, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def found(sequences, **kw):
    sizes = np.array([len(x) for x in sequences], np.int64)
    return P.runs(np.array([c for x in sequences for c in x], np.int64), sizes, **kw)


@pytest.mark.parametrize("letters", [1, 2, 3, 4, 6])
def test_runs_of_random_words(letters):
    rnd = random.Random(letters)
    seqs = [[rnd.randrange(letters) for _ in range(rnd.randint(0, 70))] for _ in range(300)]
    assert found(seqs) == [brute_runs(x) for x in seqs]


def test_runs_of_repeated_blocks():
    rnd = random.Random(7)
    seqs = []
    for _ in range(300):
        x = []
        for _ in range(rnd.randint(1, 6)):
            block = [rnd.randrange(3) for _ in range(rnd.randint(1, 9))]
            times = rnd.randint(1, 9)
            x += (block * times)[: len(block) * times - rnd.randint(0, len(block) - 1)]
            x += [rnd.randrange(100) for _ in range(rnd.randint(0, 3))]
        seqs.append(x * rnd.choice([1, 1, 2, 5]))
    assert found(seqs) == [brute_runs(x) for x in seqs]
    assert found(seqs, least=9, power=3) == [brute_runs(x, 9, 3) for x in seqs]
    assert found(seqs, least=6, power=5) == [brute_runs(x, 6, 5) for x in seqs]


def test_long_runs_take_no_quadratic_time():
    n = 60_000
    fib = [0, 1]
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    fib = b[:n]
    ones, two, blocks = [5] * n, [1, 2] * (n // 2), list(range(600)) * (n // 600)
    got = found([ones, two, blocks, fib])
    assert got[0] == [(0, n, 1)] and got[1] == [(0, n, 2)] and got[2] == [(0, n, 600)]
    assert got[3] == []                                  # no fourth power in the word of Fibonacci
    spread = [x for i in range(20_000) for x in (1, 1, 1, 1, 1, 1, 10 + i)]
    assert found([spread])[0] == [(7 * i, 6, 1) for i in range(20_000)]


CASES = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "x a a a a a a y", "a b a b a b a b", "a b a b a b a", "é ß é ß é ß é ß\x0bz",
         "a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb", "p q r " * 4 + "p q", "la " * 3000, "u v w " * 900 + "end"]


def test_query_against_brute_force(spark):
    rnd = random.Random(3)
    rows = [(i, t) for i, t in enumerate(CASES)]
    hot = " ".join(f"w{rnd.randrange(40)}" for _ in range(90))
    for i in range(100, 500):
        rows.append((i, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randint(0, 120))) if i % 3 else hot))
    rows += [(None, "a a a a a a a"), (None, None), (7, "b a b a b a b a"), (-3, "n n n n n n n n"), (7, "b a b a b a b a")]
    df = spark.createDataFrame([(t, 1, i, "x") for i, t in rows], "text string, DOC_ID int, doc_id long, Text string")
    got = P.run_digests(P.periodic_runs(P.with_planted_runs(df)))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for c, t in got.dtypes if c not in ("runs_sha256", "collapsed_sha256")] == ["bigint"] * 6
    key = lambda r: str(r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted((brute(i, t) for i, t in rows), key=key)


def test_interface(spark):
    df = spark.createDataFrame([(1, "say it say it say it say it now"), (2, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in P.periodic_runs(df).collect()}
    assert [tuple(x) for x in got[1]["runs"]] == [(0, 8, 2)] and got[1]["collapsed"] == "say it now" and got[1]["n_words"] == 9
    assert got[2]["runs"] == [] and got[2]["collapsed"] == "" and got[2]["n_words"] == 0
    empty = P.run_digests(P.periodic_runs(P.with_planted_runs(df.limit(0))))
    assert empty.count() == 0


def test_registered_query(spark):
    from citylens.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_periodic_runs"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, got)) == sorted(brute(r["doc_id"], r["text"]) for r in docs)
