import math

import numpy as np
from pyspark.sql import functions as F

from citylens.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def test_gradient_fit_recovers_ordered_thresholds():
    rng = np.random.default_rng(0)
    n, d = 8000, 6
    x = rng.random((n, d)) < 0.4
    w, theta = np.array([2.0, -1.5, 1.0, 0, 0.5, -0.5]), np.array([0.5, 2.0])
    u = rng.logistic(size=n) + x @ w
    grade = (u[:, None] > theta).sum(axis=1)
    row, feature = np.nonzero(x)
    often = np.ones(len(row), np.int64)
    m = T.fit(row, feature, often, grade, list("abcdef"), 3)
    assert np.abs(m.weights - w).max() < 0.25 and np.abs(m.thresholds - theta).max() < 0.25 and m.thresholds[0] < m.thresholds[1]
    above = m.above(row, feature, often, n)
    assert (above[:, 0] >= above[:, 1]).all()                                   # one weight per feature: thresholds never cross
    i = 17
    eta = sum(m.weights[f] for f in np.flatnonzero(x[i]))
    assert math.isclose(above[i].sum(), sum(1 / (1 + math.exp(t - eta)) for t in m.thresholds))


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    old, new = labels.where("doc_id % 4 <> 0"), labels.where("doc_id % 4 = 0")
    model = T.train(docs, T.grades_from_labels(docs, old))
    assert len(model.thresholds) == 2
    got = \
        T.score(docs, model).withColumnRenamed("toxic", "found").join(new, "doc_id").toPandas()
    hit = (got["found"] & (got["toxic"] == 1)).sum()
    # one toxic label in twenty is on a text with no toxic word at all
    assert hit / (got["toxic"] == 1).sum() >= 0.9 and (got["found"] & (got["toxic"] == 0)).sum() <= 0.005 * (got["toxic"] == 0).sum()
    assert got[got["toxic"] == 1]["severity"].mean() > 1 > got[got["toxic"] == 0]["severity"].mean()


def test_edge_rows_and_columns(spark):
    docs = spark.createDataFrame([(i, "you idiot fool" if i % 3 == 0 else "a fine day out", "p") for i in range(60)] + [(None, "you idiot", "p"), (70, None, "p"), (71, "", "p"), (3, "you idiot fool", "p")],
                                 "doc_id long, text string, severity string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 1) for i in range(60)] + [(0, 0, 1), (1000, 1, 1), (5, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int")
    model = T.train(docs, T.grades_from_labels(docs, labels))
    got = T.score(docs, model).collect()
    assert len(got) == docs.count()
    assert all(r["toxic"] == (r["doc_id"] is None or r["doc_id"] < 60 and r["doc_id"] % 3 == 0) for r in got)
    kept = T.reject_toxic(docs, model)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted([i for i in range(60) if i % 3] + [70, 71])
    assert T.score(docs.limit(0), model).count() == 0
    nothing = T.train(docs, T.grades_from_labels(docs, labels.limit(0)))
    assert T.score(docs, nothing).where("toxic or severity > 0").count() == 0


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "t") for i in range(50)], "doc_id long, text string")
    grades = spark.createDataFrame([(i, 0) for i in range(50)], "doc_id long, grade int")
    assert T.labelled_sample(docs, grades, sample=10).count() == 10


def test_model_is_fitted_on_every_labelled_row(spark):
    """A word that only labelled texts beyond the 20,000 of least id hash have is learned."""
    n = 21_000
    ids = [r["id"] for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]
    late = {i for i in ids[20_000:] if i % 2}
    rows = [(i, "vile gremlord you idiot" if i in late else "you idiot fool" if i % 5 == 0 else "a fine day out") for i in ids]
    docs = spark.createDataFrame([*rows, (n, "gremlord")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, int(t != "a fine day out")) for i, t in rows], "doc_id long, toxic int")
    model = T.train(docs, T.grades_from_labels(docs, labels))
    assert {"gremlord", "vile", "fool"} <= set(model.names)
    assert T.score(docs, model).where(F.col("doc_id") == n).first()["toxic"]


def test_fit_over_blocks_against_all_rows_at_once(spark, monkeypatch):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    grades, seen = T.grades_from_labels(docs, labels), []
    monkeypatch.setattr(T, "BLOCK", 500)
    whole = T._blocks
    monkeypatch.setattr(T, "_blocks", lambda rows, n: seen.append(whole(rows, n)) or seen[0].map(lambda b: b))
    monkeypatch.setattr(T, "drop_kept", lambda df: None)
    model = T.train(docs, grades)
    parts = seen[0].collect()
    assert len(parts) > 4 and sum(len(p[3]) for p in parts) == labels.where("toxic is not null").join(docs, "doc_id").select("doc_id").distinct().count()
    firsts = np.cumsum([0] + [len(p[3]) for p in parts[:-1]])
    row = np.concatenate([p[0] + a for p, a in zip(parts, firsts, strict=True)])
    feature, often, grade = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
    one = T.fit(row, feature, often, grade, model.names, 3)
    assert np.abs(one.weights - model.weights).max() < 0.02 and np.abs(one.thresholds - model.thresholds).max() < 0.05
    # counts of features as the texts have them
    texts = {r["doc_id"]: (r["grade"], r["graded_text"] or "") for r in grades.collect()}
    bad = sum(g > 0 for g, _ in texts.values()) / len(texts)
    for name in model.names[::97]:
        had = [g > 0 for g, t in texts.values() if name in T.features(t)]
        n, k = len(had), sum(had)
        part = lambda a, b: a * math.log(a / b) if a else 0.0
        assert math.sqrt(2 * (part(k, n * bad) + part(n - k, n * (1 - bad)))) >= T.EVIDENCE - 1e-9


def test_a_task_of_the_fit_holds_few_rows_at_once(spark):
    """A task's rows come in blocks of ROWS, so neither side of the worker's pipe holds them all."""
    n = 3 * T.ROWS + 7
    rows = spark.range(n).repartition(3).selectExpr("cast(id % 3 as int) grade", "unhex(repeat('01000000', cast(id % 5 as int))) features", "unhex(repeat('02', cast(id % 5 as int))) often")
    blocks = T._blocks(rows, n)
    got = blocks.collect()
    assert blocks.getNumPartitions() == 1 and [len(g) for *_, g in got] == [T.ROWS] * 3 + [7]
    for row, feature, often, grade in got:
        assert len(row) == len(feature) == len(often) and row.max() < len(grade) and set(feature) == {1} and set(often) == {2}
    assert sum(len(f) for _, f, _, _ in got) == sum(i % 5 for i in range(n)) and sum(g.sum() for *_, g in got) == sum(i % 3 for i in range(n))
    blocks.unpersist()
