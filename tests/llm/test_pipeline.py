"""The pipeline against brute force: toxicity by the fitted model word by word,
near duplicates by all pairs, leaks by every item around every passage, personal
data by the written patterns, packing by its contents."""

import inspect
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from citylens.llm import decontaminate as D
from citylens.llm import packing as P
from citylens.llm import pii
from citylens.llm import toxicity as T
from citylens.llm.tokens import Encoder, vocabulary

from .test_pii import brute as brute_pii
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_each_stage_against_brute_force(spark, docs):
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    cols = docs.columns
    assert [n for n, _ in C.STAGES] == ["toxicity", "simhash_near_dedup", "benchmark_decontamination", "pii", "best_fit_packing"]

    model = T.train(docs, T.grades_from_labels(docs, labels))
    weight = dict(zip(model.names, model.weights, strict=True))

    def toxic(text):
        seen = Counter(f for p in text.split() for f in T.features(p))
        eta = sum(weight[f] * min(k, T.COUNT) for f, k in seen.items() if f in weight)
        return 1 / (1 + np.exp(model.thresholds[0] - eta)) >= T.TOXIC_FROM

    before = docs.collect()
    one = C.toxicity_stage(spark, docs, SF)
    assert one.columns == cols
    assert rows_of(one) == sorted((tuple(r) for r in before if not toxic(r["text"])), key=str)

    rows = one.collect()
    two = C.simhash_stage(spark, one, SF)
    comp = brute_components([(r["doc_id"], brute_fp(r["text"])) for r in rows])
    assert rows_of(two) == sorted((tuple(r) for i, r in enumerate(rows) if comp[i] == r["doc_id"]), key=str)

    rows = two.collect()
    three = C.decontaminate_stage(spark, two, SF)
    search = D.Search(next(D._blocks(two, bench, "text", "item_id", None, D.RANK)))

    def leaked(text):
        codes = [search.coder.number.get(w, -1) for w in D.words(text)]
        return any(search.checked(k, codes[max(0, s - len(item)): s + D.WINDOW + len(item)])
                   for k, item in enumerate(search.items.codes) for s in range(0, max(1, len(codes)), D.STRIDE))

    assert rows_of(three) == sorted((tuple(r) for r in rows if not leaked(r["text"])), key=str)

    rows = three.collect()
    four = C.pii_stage(spark, three, SF)
    assert four.columns == cols and four.count() == len(rows)
    after = {r["doc_id"]: r for r in four.collect()}
    for r in rows:
        text, got = r["text"], after[r["doc_id"]]
        assert got["n_chars"] == len(got["text"])
        spans = brute_pii(text)
        if not spans and not pii.find(text):
            assert got["text"] == text
        assert not brute_pii(got["text"]) and got["text"].count("[") >= text.count("[") + bool(spans)

    five = C.packing_stage(spark, four, SF).collect()
    encode, want = Encoder(vocabulary()), Counter()
    for r in four.collect():
        n = len(next(encode.batch([r["text"]]))) + 1
        want.update((r["doc_id"], k, s, m) for k, (s, m) in enumerate(P.cut(n, P.SIZE)))
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"]) for r in five) == want


def test_run_chains_the_stages(spark, docs):
    got = C.run(spark, SF)
    again = docs
    for _, stage in C.STAGES:
        again = stage(spark, again, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert rows_of(got.select(key)) == rows_of(again.select(key))


def test_odd_rows_pass_through(spark):
    docs = spark.createDataFrame([(None, None, "en", "s", None, 1), (1, None, "en", "s", 0, 1), (2, "", None, None, 0, 1), (None, "a line of its own", "en", "s", 17, 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long, fingerprint int")
    out = docs
    for name, stage in C.STAGES[:4]:
        out = stage(spark, out, SF)
        assert out.columns == docs.columns, name
    assert {r["text"] for r in out.collect()} >= {"a line of its own"} and out.count() == 2      # the empty texts are copies of each other
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_leaks_are_sought_in_a_space_of_all_documents(spark, docs, monkeypatch):
    """More documents than the 20,000 the space was once fitted on; the step itself takes no sample."""
    many = docs.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(-(-21_000 // docs.count()))))) \
        .withColumn("text", F.concat_ws(" ", "text", F.col("copy").cast("string"))).select(docs.columns)
    seen, counts, gram = [], D.passage_frequencies, D._gram_times
    monkeypatch.setattr(D, "passage_frequencies", lambda d, items: seen.append(d.count()) or counts(d, items))
    monkeypatch.setattr(D, "_gram_times", lambda d, items, probe: seen.append(d.count()) or gram(d, items, probe))
    C.decontaminate_stage(spark, many, SF)
    assert many.count() > 20_000 and seen == [many.count()] * 2
    assert "sample" not in inspect.signature(D.fit_space).parameters
