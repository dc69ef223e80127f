"""Toxicity: cumulative-link ordinal regression over sparse text features.

Features are the words of a text and the beginnings (three to eight signs) of
its longer words, each with how often it occurs, up to ``COUNT``.  Their counts
per grade are taken over all labelled texts with Spark; those that go with
severity beyond chance are the model's features.
The model shares one weight per feature across the ordered thresholds:
``P(grade <= k) = sigmoid(theta_k - w.x)``.  Scoring reads every whole text and
outputs the expected grade ``sum_k P(grade > k)``.

The classifier is fitted on all labelled rows: their feature numbers are held in
blocks of ``ROWS`` rows, ``BLOCK`` rows to a task, and every step of the fit sums
loss and slopes over the blocks in a tree.  The driver sees one number per feature and step.

Defined results: a null text is empty and scores as a text without features;
rows repeated or without id are scored each; labels without a document or a
grade count nothing, of several grades of a document the worst does; without
two grades among the rows every score is 0; an empty table gives an empty one;
further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import islice
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType
from pyspark.storagelevel import StorageLevel

from .common import arrow_map, drop_kept, held, keep, pick, release, slices, texts_of
from .tokens import Pieces, by_size, coded

#: labelled rows of a task of the fit, and of the blocks it takes one after the other
BLOCK = 65_536
ROWS = 512
#: features kept, and the least evidence (signed root of the likelihood ratio) for each
FEATURES = 4_000
EVIDENCE = 4.0
STARTS = range(3, 9)
#: a feature that occurs more often counts this often
COUNT = 4
#: a text is toxic if a grade of 1 or more is at least this likely
TOXIC_FROM = 0.3
#: strength of the pull of weights to zero
RIDGE = 1e-4
#: features a counting task holds before it passes its counts on
_FLUSH = 200_000
_WORD = re.compile(r"\w+")


def features(piece: str) -> list[str]:
    """Features of a run of signs without white space (words, ``abc*`` beginnings)."""
    out = []
    for w in _WORD.findall(piece.lower()):
        out.append(w)
        out += [w[:k] + "*" for k in STARTS if k < len(w)]
    return out


class _Known:
    """Numbers of the features of pieces, -1-based out where not in the model; for ``Pieces``."""

    def __init__(self, names):
        self.number = {t: i for i, t in enumerate(names)}
        self.table = Pieces(self._new, np.int64)

    def _new(self, pieces):
        lists = [[self.number[t] for t in features(p) if t in self.number] for p in pieces]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((n for x in lists for n in x), np.int64, int(counts.sum())), counts

    def rows(self, texts: list[str]):
        """(row, feature, how often), each pair once, of a list of texts."""
        out, often = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        size = max(1, len(self.number))
        for a, b in by_size(texts):
            values, offsets = coded(pc.utf8_split_whitespace(pa.array(texts[a:b], pa.large_string())), self.table)
            pairs, count = np.unique((a + np.repeat(np.arange(b - a), np.diff(offsets))) * size + values, return_counts=True)
            out.append(pairs)
            often.append(np.minimum(count, COUNT))
        pairs = np.concatenate(out)
        return pairs // size, pairs % size, np.concatenate(often)


@dataclass
class Model:
    names: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    thresholds: np.ndarray = field(default_factory=lambda: np.full(1, np.inf))      # one fewer than grades; +inf: never above

    def above(self, row: np.ndarray, feature: np.ndarray, often: np.ndarray, n: int) -> np.ndarray:
        """(n, grades - 1): P(grade > k)."""
        eta = np.bincount(row, self.weights[feature] * often, minlength=n)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(self.thresholds[None, :] - eta[:, None]))


def _cut(z: np.ndarray, d: int) -> np.ndarray:
    """Thresholds of the parameters: weights, first threshold, log gaps."""
    return np.cumsum(np.concatenate([z[d: d + 1], np.exp(z[d + 1:])]))


def _sums(row: np.ndarray, feature: np.ndarray, often: np.ndarray, grade: np.ndarray, z: np.ndarray, d: int) -> np.ndarray:
    """Sums over rows: -log P(grade), its slope in every weight and in every threshold."""
    eta = np.bincount(row, z[:d][feature] * often, minlength=len(grade))
    theta = np.concatenate([[-np.inf], _cut(z, d), [np.inf]])
    up, low = (1 / (1 + np.exp(-np.clip(theta[grade + s] - eta, -700, 700))) for s in (1, 0))
    p = np.maximum(up - low, 1e-12)
    du, dl = up * (1 - up) / p, low * (1 - low) / p
    slopes = np.bincount(feature, (du - dl)[row] * often, minlength=d)                  # d/d eta of -log p is du - dl
    dt = [(-du[grade == k]).sum() + dl[grade == k + 1].sum() for k in range(len(z) - d)]
    return np.concatenate([[-np.log(p).sum()], slopes, dt])


def fit(row: np.ndarray, feature: np.ndarray, often: np.ndarray, grade: np.ndarray, names: list[str], grades: int, steps: int = 300) -> Model:
    """Proportional-odds model, ridge-penalised, of rows at hand."""
    return fit_sums(lambda z: _sums(row, feature, often, grade, z, len(names)), np.bincount(grade, minlength=grades), names, steps)


def fit_sums(sums: Callable[[np.ndarray], np.ndarray], sizes: np.ndarray, names: list[str], steps: int = 300) -> Model:
    """The same from the sums over rows at given parameters and the number of
    rows of each grade, by limited-memory quasi-Newton steps."""
    n, d = sizes.sum(), len(names)
    share = (np.cumsum(sizes)[:-1] / n).clip(1e-4, 1 - 1e-4)
    gaps = np.maximum(np.diff(np.log(share / (1 - share))), 1e-3)
    x = np.concatenate([np.zeros(d), [math.log(share[0] / (1 - share[0]))], np.log(gaps)])       # weights, first cut, log gaps

    def loss(z):
        total = sums(z) / n
        g, dt = total[1:], total[1 + d:].copy()
        g[:d] += RIDGE * z[:d]
        g[d] = dt.sum()
        g[d + 1:] = np.exp(z[d + 1:]) * dt[::-1].cumsum()[::-1][1:]
        return total[0] + RIDGE / 2 * (z[:d] ** 2).sum(), g

    f, g = loss(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, use = g.copy(), []
        for s, y, r in reversed(past):
            use.append(r * (s @ q))
            q -= use[-1] * y
        if past:
            s, y, _ = past[-1]
            q *= (s @ y) / (y @ y)
        for (s, y, r), a in zip(past, reversed(use), strict=True):
            q += s * (a - r * (y @ q))
        slope = -(q @ g)
        if slope >= 0:
            past, q, slope = [], g.copy(), -(g @ g)
        step = 1.0 if past else min(1.0, 1 / np.sqrt(g @ g + 1e-30))
        while True:
            nxt = x - step * q
            fn, gn = loss(nxt)
            if fn <= f + 1e-4 * step * slope or step < 1e-10:
                break
            step /= 2
        s, y = nxt - x, gn - g
        if s @ y > 1e-12:
            past = [*past[-9:], (s, y, 1 / (s @ y))]
        done = f - fn < 1e-10 * max(1.0, abs(f))
        x, f, g = nxt, fn, gn
        if done:
            break
    return Model(names, x[:d], _cut(x, d))


def labelled_sample(docs: DataFrame, grades: DataFrame, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, grade, text) of all graded documents; with ``sample`` of at most so many, by least id hash."""
    worst = pick(grades, g_id="doc_id", grade="grade").where("grade is not null and g_id is not null").groupBy("g_id").agg(F.max("grade").alias("grade"))
    if sample is not None:
        worst = F.broadcast(worst.orderBy(F.xxhash64("g_id"), "g_id").limit(sample))
    own = pick(docs, doc_id=id_col, text=text_col)
    return own.join(worst, F.col("doc_id") == F.col("g_id")).groupBy("doc_id").agg(
        F.max("grade").cast("int").alias("grade"), F.min("text").alias("text"))


class _Counts:
    """In how many texts each feature is, and in how many of them above the lowest grade."""

    def __init__(self):
        self.number: dict[str, int] = {}
        self.table = Pieces(self._new, np.int64)
        self.every = self.worse = np.zeros(0, np.int64)

    def _new(self, pieces):
        number = self.number
        lists = [[number.setdefault(t, len(number)) for t in features(p)] for p in pieces]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((n for x in lists for n in x), np.int64, int(counts.sum())), counts

    def add(self, texts: list[str], worse: np.ndarray) -> None:
        values, offsets = coded(pc.utf8_split_whitespace(pa.array(texts, pa.large_string())), self.table)
        size = max(1, len(self.number))
        pairs = np.unique(np.repeat(np.arange(len(texts)), np.diff(offsets)) * size + values)      # each feature once a text
        text, feature = pairs // size, pairs % size
        self.every, self.worse = (np.bincount(f, minlength=size) + np.pad(had, (0, size - len(had)))
                                  for f, had in ((feature, self.every), (feature[worse[text]], self.worse)))

    def batches(self):
        names = pa.array(list(self.number), pa.string())
        for at in range(0, len(names), 50_000):
            yield pa.RecordBatch.from_arrays([names[at: at + 50_000], *(pa.array(c[at: at + 50_000]) for c in (self.every, self.worse))], names=["feature", "n", "k"])


def _blocks(rows: DataFrame, n: int):
    """An RDD of (row, feature, often, grade) arrays of ``ROWS`` rows each, about
    ``BLOCK`` rows to a partition: a step holds one block's arrays, not a task's."""
    def block(part):
        while got := [(r["grade"], r["features"], r["often"]) for r in islice(part, ROWS)]:
            yield (np.repeat(np.arange(len(got), dtype=np.int32), [len(o) for *_, o in got]), np.frombuffer(b"".join(f for _, f, _ in got), "<i4"),
                   np.frombuffer(b"".join(o for *_, o in got), "i1"), np.array([g for g, *_ in got], np.int32))

    return rows.coalesce(max(1, -(-n // BLOCK))).rdd.mapPartitions(block).persist(StorageLevel.DISK_ONLY)


def train(docs: DataFrame, grades: DataFrame, sample: int | None = None, most: int = FEATURES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fits the model on all graded documents; ``grades``: (doc_id, grade), grades
    0, 1, 2 ... by severity, and where given the ``graded_text`` of each (as
    ``grades_from_labels`` has it), which is then not looked up again.  With
    ``sample`` (to measure what that changes) on at most so many."""
    if sample is None and "graded_text" in grades.columns:
        rows = pick(grades, doc_id="doc_id", grade="grade", text="graded_text")
    else:
        rows = keep(labelled_sample(docs, grades, sample, id_col, text_col), "labelled", tidy=True)
    sizes = {r["grade"]: r["n"] for r in rows.groupBy("grade").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model()
    levels = sorted(sizes)
    at = {g: i for i, g in enumerate(levels)}
    bad, total = sum(n for g, n in sizes.items() if g > levels[0]), sum(sizes.values())

    def spell(batches):
        release("spell")
        counts = _Counts()
        for batch in slices(batches, 1024):
            worse, texts = batch.column("grade").to_numpy() > levels[0], texts_of(batch)
            for i, j in by_size(texts, 1_000_000):
                counts.add(texts[i:j], worse[i:j])
                if len(counts.number) > _FLUSH:
                    yield from counts.batches()
                    counts = _Counts()
        yield from counts.batches()

    spelled = rows.select("grade", "text").mapInArrow(spell, "feature string, n long, k long")
    counted = spelled.groupBy("feature").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    # signed root of the likelihood ratio of k of n against the share of all
    p, n, k = F.lit(bad / total), F.col("n").cast("double"), F.col("k").cast("double")

    def part(a, b):
        return F.when(a > 0, a * F.log(a / b)).otherwise(0.0)

    g = F.signum(k - n * p) * F.sqrt(F.greatest(F.lit(0.0), 2 * (part(k, n * p) + part(n - k, n * (1 - p)))))
    chosen = counted.withColumn("g", g).where(F.abs("g") >= EVIDENCE).orderBy(F.abs("g").desc(), "feature").limit(most)
    names = sorted(r["feature"] for r in chosen.select("feature").collect())           # at most ``most``
    known, d = _Known(names), len(names)

    def code(batch):
        row, feature, often = known.rows(texts_of(batch))
        ends = np.cumsum(np.bincount(row, minlength=batch.num_rows))[:-1]
        return {"grade": [at[g] for g in batch.column("grade").to_pylist()], "features": [x.astype("<i4").tobytes() for x in np.split(feature, ends)],
                "often": [x.astype("i1").tobytes() for x in np.split(often, ends)]}

    numbers = keep(arrow_map(rows.select("grade", "text"), code, "grade int, features binary, often binary", 1024), "numbers", tidy=True)
    blocks = _blocks(numbers, total)
    model = fit_sums(lambda z: blocks.map(lambda b: _sums(*b, z, d)).treeReduce(np.add), np.array([sizes[g] for g in levels]), names)
    blocks.unpersist()
    drop_kept(numbers)
    return model


def severity(model: Model, docs: DataFrame):
    """A pandas UDF: text -> struct(severity, p_toxic) by the model."""
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid4().hex
    kind = StructType([StructField("severity", DoubleType()), StructField("p_toxic", DoubleType())])

    @F.pandas_udf(kind)
    def score(texts: pd.Series) -> pd.DataFrame:
        known, own = held(f"toxicity-{name}", "", lambda: (_Known(shared.value.names), shared.value))
        signs = [t or "" for t in texts]
        above = np.concatenate([np.zeros((0, len(own.thresholds))), *(own.above(*known.rows(signs[a:b]), b - a) for a, b in by_size(signs))])
        return pd.DataFrame({"severity": above.sum(axis=1), "p_toxic": above[:, 0]})

    return score


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, severity, p_toxic, toxic) of every document."""
    own = pick(docs, doc_id=id_col, text=text_col)
    s = own.select("doc_id", severity(model, own)("text").alias("s"))
    return s.select("doc_id", "s.severity", "s.p_toxic", (F.col("s.p_toxic") >= TOXIC_FROM).alias("toxic"))


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` without those the model finds toxic; all columns are kept."""
    cols = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    text = f"_c{cols.index(text_col)}"
    return flat.where(severity(model, flat)(text)["p_toxic"] < TOXIC_FROM).toDF(*cols)


def grades_from_labels(docs: DataFrame, labels: DataFrame, sample: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Grades 0 to 2 from 0/1 labels, with the text of each: 0 not toxic; a toxic
    text is graded by how many words it has that the labelled texts show in toxic
    ones only (three or more of them) -- 2 if more than the median toxic text, else 1."""
    own = pick(labels, doc_id="doc_id", grade="toxic")
    rows = keep(labelled_sample(docs, own, sample, id_col, text_col), "graded", tidy=True)
    words = rows.select("doc_id", "grade", F.explode(F.array_distinct(F.split(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}_]+", " "), " "))).alias("w"))
    only = words.groupBy("w").agg(F.count("*").alias("n"), F.min("grade").alias("least")).where("least = 1 and n >= 3 and w <> ''").select("w")
    hits = words.where("grade = 1").join(only, "w", "left_semi").groupBy("doc_id").agg(F.count("*").alias("hits"))
    toxic = keep(rows.where("grade = 1").join(hits, "doc_id", "left").select("doc_id", "text", F.coalesce("hits", F.lit(0)).alias("hits")), "hits", tidy=True)
    middle = toxic.agg(F.percentile("hits", 0.5).alias("m"))
    return rows.where("grade = 0").select("doc_id", F.lit(0).alias("grade"), F.col("text").alias("graded_text")).unionByName(
        toxic.join(F.broadcast(middle)).select("doc_id", F.when(F.col("hits") > F.col("m"), 2).otherwise(1).alias("grade"), F.col("text").alias("graded_text")))
