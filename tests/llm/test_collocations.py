import random
import re
from collections import Counter

import numpy as np
import pytest

from citylens.llm import collocations as C
from citylens.llm import transducers as T


def brute(rows, least=10, share=50, top=2000):
    f = Counter()
    n = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = [x for x in re.split("[ \t]", piece) if x]
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    out = []
    for lang in n:
        cand = {p: a for (x, p), a in f.items() if x == lang and len(p) > 1 and a >= least}
        got = []
        for p, a in cand.items():
            if any(100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cand.items() if len(q) > len(p)):
                continue
            cuts = [(1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            s, k = min(cuts)
            got.append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        for rank, (s, a, p, l, r) in enumerate(sorted(got)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def some_rows(seed, size=400):
    rnd = random.Random(seed)
    words = ["the", "of", "New", "york", "City", "a", "é", "Éa", "ß", "x\x1cy", "b c", "(it)", "z", "日本"] + [f"w{i}" for i in range(12)]
    out = []
    for _ in range(size):
        t = ""
        for _ in range(rnd.randint(0, 40)):
            t += rnd.choice(words[: rnd.choice([4, 9, 26])]) + rnd.choice([" "] * 8 + ["\t", "  ", ". ", ",", "!\n", "\x0b", "\r", "?"])
        out.append((rnd.choice(["en", "en", "en", "de", None, "und"]), t))
    hot = "new york city hall is the place of the new york city hall. "
    return out + [("en", hot * 3)] * 90 + [("de", None), (None, ""), ("fr", " .,\t"), ("fr", "one word"), ("en", "la " * 4000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    rows = some_rows(seed)
    df = spark.createDataFrame([(i % 7 or None, t, lang, "x") for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string, LANG string")
    want = brute(rows)
    assert len(want) > 50
    if seed == 2:                                       # many ranges, flushes within a text, answers from many ranges
        monkeypatch.setattr(C, "_TOKENS", 300)
        monkeypatch.setattr(C, "_STRETCH", 97)
    got = C.collocations(df, range_bytes=1 << 25 if seed == 1 else 1000)
    assert [t for c, t in got.dtypes if c not in ("lang", "phrase")] == ["bigint"] * 6
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(got) == want


def test_parameters_and_edges(spark):
    rows = some_rows(3, 120)
    df = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string")
    assert C.ranges_of(df, range_bytes=2000) > 4       # ranked in more than two steps
    for fan in (2, 256):
        assert rows_of(C.collocations(df, least=3, share=80, top=7, range_bytes=2000, fan=fan)) == brute(rows, 3, 80, 7)
    assert C.collocations(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, None), ("en", "...")], "lang string, text string")
    assert C.collocations(alone).count() == 0


def test_scores_beyond_64_bits():
    a = np.array([3_000_000_000_000, 7], np.int64)
    assert C._floor(a, a + 1, a + 2).tolist() == [1_000_000 * x * x // ((x + 1) * (x + 2)) for x in a.tolist()]


def counted(c):
    w = [x.decode() for x in c.words.to_pylist()]
    return {**{(w[i],): f for i, f in zip(c.one, c.f1, strict=True)}, **{(w[i], w[j]): f for (i, j), f in zip(c.two, c.f2, strict=True)},
            **{(w[c.two[p, 0]], w[c.two[p, 1]], w[i]): f for p, i, f in zip(c.parent, c.three, c.f3, strict=True)}}


def direct(words):
    out = Counter()
    for k in (1, 2, 3):
        for i in range(len(words) - k + 1):
            if "." not in words[i:i + k]:
                out[tuple(words[i:i + k])] += 1
    return dict(out)


def automaton(words):
    number = C._Numbers({b".": 0})
    return T.from_codes(np.array([number[x.encode()] for x in words], np.int64), list(number))


def test_transducers():
    rnd = random.Random(5)
    texts = [[rnd.choice("a b c dd é . zz q".split()) for _ in range(n)] for n in (0, 1, 2, 3, 50, 400)] + [["."], ["a"] * 30]
    every = Counter()
    parts = []
    for words in texts:
        c = automaton(words)
        assert counted(c) == direct(words)
        assert counted(T.from_bytes(T.to_bytes(c))) == direct(words)
        pieces = [x for _, x in T.cut(c, 5)]
        again = T.Adding(least=1)
        for x in pieces:
            again.add(T.from_bytes(T.to_bytes(x)))
        assert counted(again.total()) == direct(words)
        every.update(direct(words))
        parts.append(c)
    whole = T.union(parts)
    assert counted(whole) == dict(every)
    assert whole.words.to_pylist() == sorted(whole.words.to_pylist())
    assert counted(T.at_least(whole, 9)) == {p: f for p, f in every.items() if f >= 9}
    asked = automaton("a b . q nowhere . é".split())
    asked = T.Counts(asked.words, asked.one, asked.f1 * 0, asked.two, asked.f2 * 0, *[np.zeros(0, np.int64)] * 3)
    assert counted(T.compose(asked, whole)) == {p: every[p] for p in counted(asked)}


def test_equal_states_are_one():
    """Pairs with the same weighted continuations lead to the same state."""
    c = automaton("a x y . b x y . c x y . c x z .".split())
    state, sizes, _, _ = T._states(c)
    by = {(c.words[i].as_py(), c.words[j].as_py()): s for (i, j), s in zip(c.two.tolist(), state.tolist(), strict=True)}
    assert by[b"a", b"x"] == by[b"b", b"x"] != by[b"c", b"x"] and by[b"x", b"y"] == 0 and sorted(sizes.tolist()) == [1, 2]


def test_prefix_stays_in_one_range():
    rnd = random.Random(6)
    seen = {}
    for _ in range(20):
        words = [rnd.choice(["the", "of", *[f"w{i}" for i in range(30)]]) for _ in range(300)]
        for r, c in T.cut(automaton(words), 7):
            for p in counted(c):
                assert seen.setdefault(p[:2], r) == r
    assert set(seen.values()) == set(range(7))
