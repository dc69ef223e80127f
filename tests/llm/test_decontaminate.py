import random

import numpy as np

from citylens.llm import decontaminate as D


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            row[j], prev = (prev + 1 if x == y else max(row[j], row[j - 1])), row[j]
    return row[-1]


def test_common_subsequence_against_the_recurrence():
    rnd = random.Random(1)
    for _ in range(500):
        a = [rnd.randrange(6) for _ in range(rnd.randint(1, 70))]
        b = [rnd.randrange(8) for _ in range(rnd.randint(0, 90))]
        masks = {}
        for i, w in enumerate(a):
            masks[w] = masks.get(w, 0) | 1 << i
        assert D.common_subsequence(masks, len(a), b) == lcs(a, b)


def corpus(seed=3):
    rnd = random.Random(seed)
    common, rare = [f"c{i}" for i in range(40)], [f"r{i}" for i in range(3000)]
    prose = lambda n: [rnd.choice(common) if rnd.random() < 0.6 else rnd.choice(rare) for _ in range(n)]
    items = [prose(rnd.randint(15, 60)) for _ in range(25)]
    rows, truth = [], set()
    for i in range(160):
        text = prose(rnd.choice([0, 3, 40, 200, 700]))
        if i % 4 == 0:
            k = rnd.randrange(25)
            leak = list(items[k])
            if i % 8 == 0:                                        # a paraphrase: a tenth of the words replaced, one inserted
                for _ in range(len(leak) // 10):
                    leak[rnd.randrange(len(leak))] = "instead"
                leak.insert(len(leak) // 2, "inserted")
            at = rnd.randint(0, len(text))
            text[at:at] = leak
            truth.add((i, k))
        rows.append((i, (" ".join(text)).title() + "."))
    return items, rows, truth


def test_leaks_against_brute_force_and_truth(spark):
    items, rows, truth = corpus()
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id long, text string, cosine double").repartition(5)
    bench = spark.createDataFrame([(k, " ".join(t).upper()) for k, t in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench).collect()}
    assert got == truth
    fitted = next(D._blocks(docs, bench, "text", "item_id", None, D.RANK))
    search = D.Search(fitted)
    brute = set()
    for i, t in rows:                                             # every item around every passage, no cosine
        codes = [search.coder.number.get(w, -1) for w in D.words(t)]
        for k, item in enumerate(fitted.codes):
            n = len(item)
            if any(search.checked(k, codes[max(0, s - n): s + D.WINDOW + n]) for s in range(0, max(1, len(codes)), D.STRIDE)):
                brute.add((i, fitted.ids[k]))
    assert len(got & brute) >= 0.9 * len(brute)
    kept = D.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in rows} - {i for i, _ in truth}


def test_space_holds_the_leading_directions(spark):
    items, rows, _ = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    it = D.items_of([(k, " ".join(t), None) for k, t in enumerate(items)])
    n, df = D.passage_frequencies(docs.select("text"), it)
    cells, passages = [], []
    for _, t in rows:
        ws = D.words(t)
        own = [ws[s: s + D.STRIDE] for s in range(0, len(ws), D.STRIDE)]
        cells += own
        passages += [a + (own[i + 1] if i + 1 < len(own) else []) for i, a in enumerate(own)]
    assert n == len(cells) and df.tolist() == [sum(w in set(c) for c in cells) for w in it.vocabulary]
    it.idf = np.log((n + 1) / (df + 1)) + 0.1
    number = {w: i for i, w in enumerate(it.vocabulary)}
    a = np.zeros((len(passages), len(number)))
    for r, p in enumerate(passages):
        for w in p:
            if w in number:
                a[r, number[w]] += it.idf[number[w]]
    probe = np.random.default_rng(2).standard_normal((len(number), 20))
    assert np.allclose(D._gram_times(docs.select("text"), it, probe), a.T @ (a @ probe), rtol=1e-3, atol=1e-2)


def test_space_is_fitted_on_every_text(spark, monkeypatch):
    items, *_ = corpus(6)
    rnd = random.Random(8)
    known = sorted({w for t in items for w in t})
    rows = [(" ".join(rnd.choice(known) for _ in range(6)),) for _ in range(25_000)]        # more than the 20,000 once taken
    it, seen = D.items_of([(k, " ".join(t), None) for k, t in enumerate(items)]), []
    whole = D._gram_times
    monkeypatch.setattr(D, "_gram_times", lambda docs, items, probe: seen.append((probe, whole(docs, items, probe))) or seen[0][1])
    D.fit_space(spark.createDataFrame(rows, "text string").repartition(4), it, rank=8)
    number = {w: i for i, w in enumerate(it.vocabulary)}
    a = np.zeros((len(rows), len(number)))
    for r, (t,) in enumerate(rows):
        for w in D.words(t):
            a[r, number[w]] += it.idf[number[w]]
    probe, got = seen[0]
    assert np.allclose(got, a.T @ (a @ probe), rtol=1e-3, atol=0.1)


def test_answers_and_edge_rows(spark):
    text = "the quick brown fox jumps over the lazy dog near a calm river bank today"
    bench = spark.createDataFrame([(1, text, "river bank"), (2, text, "snowy peak"), (3, None, None), (4, "", "x"), (5, "...", None)], "item_id long, text string, answer string")
    docs = spark.createDataFrame([(1, text, 1), (1, text, 1), (None, "Well: " + text, 1), (2, None, 1), (3, "", 1), (4, "another text " * 50, 1)], "doc_id long, text string, item_id int")
    got = sorted(((r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench, answer_col="answer").collect()), key=str)
    assert got == [(1, 1), (1, 1), (None, 1)]
    assert sorted(r["item_id"] for r in D.leaks(docs.limit(1), bench).collect()) == [1, 2]
    assert D.leaks(docs.limit(0), bench).count() == 0 and D.leaks(docs, bench.limit(0)).count() == 0
    assert D.drop_leaks(docs, bench.limit(0)).count() == 6


def test_product_of_items_against_the_matrix():
    rnd = random.Random(4)
    it = D.items_of([(k, " ".join(f"w{rnd.randrange(50)}" for _ in range(rnd.randint(0, 30))), None) for k in range(40)])
    it.idf = np.random.default_rng(1).random(len(it.vocabulary)) + 0.1
    b = np.zeros((40, len(it.vocabulary)))
    for r, codes in enumerate(it.codes):
        np.add.at(b[r], codes, it.idf[codes])
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    probe = np.random.default_rng(2).standard_normal((len(it.vocabulary), 9))
    assert np.allclose(D._items_times(it, probe), b.T @ (b @ probe))


def test_a_large_block_of_items_stays_small():
    """4,096 items of 60 words of their own: as a matrix 1.8 GB."""
    import tracemalloc

    it = D.items_of([(k, " ".join(f"w{(k * 13 + i * 7919) % 54_000}" for i in range(60)), None) for k in range(4096)])
    it.idf = np.ones(len(it.vocabulary))
    probe = np.random.default_rng(2).standard_normal((len(it.vocabulary), D.RANK))
    tracemalloc.start()
    out = D._items_times(it, probe)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out.shape == probe.shape and peak < 400 << 20


def test_recall_where_the_space_is_fitted_on_a_sample(spark):
    """A seventh of the documents fit the space; leaks of all are found, exact and reworded."""
    items, rows, truth = corpus(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    bench = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.leaks(docs, bench, sample=23).collect()}
    exact, reworded = ({x for x in truth if (x[0] % 8 == 0) == flag} for flag in (False, True))
    assert got <= truth and len(got & exact) >= 0.9 * len(exact) and len(got & reworded) >= 0.9 * len(reworded)


def test_words_as_numbers():
    rnd = random.Random(6)
    parts = ["word", "Word", "WORD9", "x_y", "_", "'s", "don't", "(a)", "a-b", "...", "é", "Éa", "İx", "ΣΑΣ", "日本", "a,", "\"b\"", "--c--", "3.5", "ß!", "\u00a0", "a\u2003b", "½", "x²", "$$"]
    texts = ["", " ", *[" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(40)]]
    vocabulary = sorted({w for t in texts for w in D.words(t)} - {"word9", "b", "日本"})
    coder = D._Coder(vocabulary)
    for _ in range(2):
        values, offsets = coder(texts)
        assert [values[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)] == [[coder.number.get(w, -1) for w in D.words(t)] for t in texts]
