import math
import random
from collections import Counter

import numpy as np
import pytest

from citylens.llm import quality as Q

M64 = (1 << 64) - 1


def brute_passages(text):
    data, out, at = (text or "").encode(), [], 0
    n = len(data)
    goal = Q.PASSAGE
    while n > Q.PASSAGE + 128 and goal < n - 128:
        end = goal
        for e in range(goal, goal + 129):
            if data[e] in b" \t\n\x0b\x0c\r":
                end = e
                break
        out.append(data[at:end])
        at, goal = end, goal + Q.PASSAGE
    return [*out, data[at:]]


def brute_describe(p):
    """The features of one passage, byte by byte."""
    sign, pair, words, cur = Counter(), Counter(), [], None
    for i, b in enumerate(p):
        sign[int(Q._SIGN[b])] += 1
        if i:
            pair[int(Q._COARSE[p[i - 1]]), int(Q._COARSE[b])] += 1
        if b in b" \t\n\x0b\x0c\r":
            cur = None
        elif cur is None:
            cur = []
            words.append(cur)
        if cur is not None:
            cur.append(b)
    hashes = []
    for w in words:
        h = 0
        for i, b in enumerate(w):
            c = chr(b)
            known = b >= 128 or (c.isascii() and c.isalnum())
            h += (b + 32 if 65 <= b <= 90 else b) * pow(0x9E3779B97F4A7C15, i % 64 + 1, 1 << 64) if known else 0
        h = (h & M64) * 0xD6E8FEB86659FD93 & M64
        hashes.append(h ^ (h >> 29))
    out = [0.0] * Q.WIDTH
    n, m = max(len(p), 1), max(len(words), 1)
    for k, c in sign.items():
        out[k] = math.sqrt(c / n)
    for (a, b), c in pair.items():
        out[Q._SIGNS + a * Q._PAIRS + b] = math.sqrt(c / n)
    at = Q._SIGNS + Q._PAIRS ** 2
    for k, c in Counter((h * 0xD6E8FEB86659FD93 & M64) >> 55 for h in hashes).items():
        out[at + k] = math.sqrt(c / m)
    at += 512
    out[at] = math.log1p(len(p))
    if words:
        same = Counter(hashes)
        out[at + 1:] = [math.log1p(len(words)), len(words) * 6 / n, len(same) / m, max(same.values()) / m,
                    sum(a == b for a, b in zip(hashes, hashes[1:], strict=False)) / m]
    return out


def brute_score(model, text):
    """Gated attention, passage by passage."""
    w = {k: np.asarray(v, np.float64) for k, v in model.weights.items()}
    hs, es = [], []
    for p in brute_passages(text):
        x = np.clip((np.array(brute_describe(p)) - w["mean"]) * w["scale"], -5, 5)
        h = np.tanh(x @ w["W"] + w["b"])
        hs.append(h)
        es.append(w["w"] @ (np.tanh(h @ w["V"]) / (1 + np.exp(-(h @ w["U"])))))
    a = np.exp(np.array(es) - max(es))
    z = (a / a.sum()) @ np.array(hs)
    return float(1 / (1 + np.exp(-(z @ w["c"] + w["c0"][0]))))


TEXTS = ["", " ", "\n\t ", "word", "One two, TWO two! 3 $$ é", "x" * 5000, "a b " * 900, "Ünï cödé " * 200, "!!! ... ---", "  lead\n\n\nand trail  ", "tab\tsep\x0bv"]


def some_model():
    x = np.concatenate([Q.describe(d, np.diff(Q.cut(d), prepend=0)) for d in (np.frombuffer(t.encode(), np.uint8) for t in TEXTS)])
    bags = np.array([len(Q.cut(np.frombuffer(t.encode(), np.uint8))) for t in TEXTS])
    return Q.fit(x, bags, (np.arange(len(TEXTS)) % 2).astype(np.float32), epochs=3), x, bags


@pytest.mark.parametrize("text", TEXTS)
def test_passages_and_features(text):
    data = np.frombuffer(text.encode(), np.uint8)
    ends = Q.cut(data)
    assert [data[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends, strict=True)] == brute_passages(text)
    got = Q.describe(data, np.diff(ends, prepend=0))
    assert np.allclose(got, [brute_describe(p) for p in brute_passages(text)], atol=1e-5)


def test_scores_against_brute_force(spark, monkeypatch):
    model, _, _ = some_model()
    rnd = random.Random(4)
    texts = [*TEXTS, None, *[" ".join(rnd.choice(["the", "of", "AND", "r!!", "q%%%", "|", "é"]) for _ in range(rnd.randint(0, 700))) for _ in range(60)]]
    monkeypatch.setattr(Q, "_BLOCK", 1500)              # passages of one text in several blocks
    want = [brute_score(model, t) for t in texts]
    assert np.allclose(Q.scores_of(model, [(t or "").encode() for t in texts]), want, atol=1e-4)
    df = spark.createDataFrame([(None if i == 3 else i % 50, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, Text string")
    got = Q.score(df, model).collect()
    key = lambda r: (str(r[0]), round(r[1], 3))
    for g, w in zip(sorted(((r["doc_id"], r["score"]) for r in got), key=key), sorted(((None if i == 3 else i % 50, s) for i, s in enumerate(want)), key=key), strict=True):
        assert g[0] == w[0] and abs(g[1] - w[1]) < 1e-3


def test_fit_descends():
    rng = np.random.default_rng(5)
    bags, label = np.array([1, 3, 2, 4]), np.array([1, 0, 1, 0], np.float32)
    x = rng.normal(size=(10, 6)).astype(np.float32)
    few, many = Q.fit(x, bags, label, epochs=1), Q.fit(x, bags, label, epochs=300)

    def loss(m):
        p = m.scores(m.encode(x), bags)
        return -np.mean(label * np.log(p) + (1 - label) * np.log(1 - p))

    assert loss(many) < 0.1 < loss(few)
    again = Q.fit(x, bags, label, epochs=300)
    assert all(np.array_equal(many.weights[k], again.weights[k]) for k in many.weights)
    back = Q.unpacked(Q.packed(many))
    assert np.array_equal(back.scores(back.encode(x), bags), many.scores(many.encode(x), bags))


def test_one_bad_passage_decides(spark):
    """Labels are of documents; the model finds the passage that spoils one."""
    rnd = random.Random(8)
    prose = lambda n: " ".join(rnd.choice(["river", "stone", "walks", "under", "green", "light", "every", "house"]) for _ in range(n))
    docs, labels = [], []
    for i in range(500):
        text = prose(rnd.randint(300, 500))
        if i % 3 == 0:
            at = rnd.randint(0, len(text) - 1)
            text = text[:at] + " " + " ".join(rnd.choice(["zz%%", "qq&&", "##"]) for _ in range(120)) + " " + text[at:]
        docs.append((i, text))
        labels.append((i, int(i % 3 != 0)))
    got = Q.classify(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    out = [r for r in got if r["held_out"]]
    assert len(out) > 60 and sum(r["predicted"] == (r["doc_id"] % 3 != 0) for r in out) / len(out) > 0.95


def test_only_given_labels_are_learned(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality")
    import pyspark.sql.functions as F

    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("s")})
    a, b = (sorted(map(tuple, Q.classify(d, x).collect())) for d, x in ((docs, labels), (other, turned)))
    assert a == b


def test_edges(spark):
    docs = spark.createDataFrame([(1, "good text here", 1), (1, "good text here", 2), (2, None, 3), (None, "", 4), (3, "x" * 3000, 5)], "doc_id long, text string, Doc_ID int")
    kind = "doc_id long, quality int"
    for rows, want in (([], 0.5), ([(1, 1), (2, None), (None, 0), (99, 0)], 1.0), ([(1, 0), (1, 1), (2, 0)], 0.0)):
        got = Q.score(docs, Q.train(docs, spark.createDataFrame(rows, kind))).collect()
        assert len(got) == 5 and {r["score"] for r in got} == {want}
    both = Q.classify(docs, spark.createDataFrame([(1, 1), (2, 0), (3, 1)], kind)).collect()
    assert len(both) == 5 and all(0 <= r["score"] <= 1 for r in both) and sum(r["doc_id"] is None and not r["held_out"] for r in both) == 1
    empty = Q.classify(docs.limit(0), spark.createDataFrame([], kind))
    assert empty.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")] and empty.count() == 0


def test_registered_query_on_held_out_labels(spark):
    from citylens.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op13_quality_classifier"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == 1000
    held = [(r["quality"], got[r["doc_id"]]) for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
            if r["doc_id"] in got and got[r["doc_id"]]["held_out"]]
    assert len(held) > 50
    assert np.mean([q == r["predicted"] for q, r in held]) >= 0.95
    good, bad = [r["score"] for q, r in held if q], [r["score"] for q, r in held if not q]
    assert np.mean([[g > b for b in bad] for g in good]) > 0.97
