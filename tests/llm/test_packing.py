import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from citylens.llm import packing as P
from citylens.llm.tokens import Encoder, vocabulary


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_tokenizer(reference):
    rnd = random.Random(1)
    texts = ["", " ", "  ", " a", "a ", "a\nb", "a\n\nb", "\na", "a \nb", "it's 's 12a ,.", "<|endoftext|> x", "é ñ x", "a\tb", "a\r\nb",
             "x\x1cy", "日本 語 12٣", "\n", "😀 😀a​ b", "a b", "word " * 9000]
    texts += ["".join(rnd.choice("ab1,' \n\té's.日") for _ in range(rnd.randint(0, 30))) for _ in range(1500)]
    e = Encoder(vocabulary(), limit=50)
    for _ in range(2):
        for t, ids in zip(texts, e.batch(texts), strict=True):
            assert ids.tolist() == reference(t), t


def test_added_tokens_have_their_own_id(spark):
    default = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))            # as the library comes
    rnd = random.Random(3)
    texts = ["hello <|endoftext|> there", "<|endoftext|>", "a<|endoftext|>b", "<|endoftext|><|endoftext|> x", "a\n<|endoftext|>\n\nb", "<|endoftext|", "plain text"]
    texts += ["".join(rnd.choice(["<|endoftext|>", "<|", "a", " ", "\n", "word", "é"]) for _ in range(rnd.randint(0, 12))) for _ in range(500)]
    want = Counter()
    for i, t in enumerate(texts):
        ids = np.array(default.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want[(i, len(ids), zlib.crc32(ids.tobytes()))] += 1
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert Counter((r["doc_id"], r["length"], r["ids_crc32"]) for r in P.best_two_fit(docs).collect()) == want


def first_fit_decreasing(lengths):
    bins = []
    for n in sorted(lengths, reverse=True):
        i = next((i for i, used in enumerate(bins) if used + n <= 2048), None)
        if i is None:
            bins.append(n)
        else:
            bins[i] += n
    return len(bins)


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece_once_and_is_tight(seed):
    rnd = random.Random(seed)
    counts = Counter(min(2048, int(rnd.lognormvariate(6, 1)) + 1) for _ in range(rnd.randint(1, 4000)))
    plan = P.plan_bins(dict(counts))
    used, total = Counter(), 0
    for times, held in plan:
        assert times > 0 and sum(held) <= 2048
        for x in held:
            used[x] += times
        total += times
    assert used == counts
    least = -(-sum(k * v for k, v in counts.items()) // 2048)
    assert total <= max(least + 1, 1.02 * least, sum(v for k, v in counts.items() if k > 1024))


def test_two_smaller_ones_replace_the_smallest():
    # greedy: 6 + 3 leaves 1 of 10; 2 + 2 fill the widened gap of 4
    assert P.plan_bins({6: 1, 3: 1, 2: 2}, 10)[0] == (1, [6, 2, 2])
    assert P.plan_bins({}, 10) == []


def test_packing_round_trip(spark, reference):
    rnd = random.Random(4)
    words = ["alpha", "beta", "gamma,", "delta.", "épsilon", "12", "zeta\n"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 50, 400, 900, 3000])))) for i in range(150)]
    rows += [(500, None), (501, ""), (3, rows[3][1]), (None, "no id"), (7, rows[7][1])] + [(600 + i, "same text") for i in range(200)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, length int")
    got = P.best_two_fit(docs).collect()
    want = Counter()
    for i, t in rows:
        ids = np.array(reference(t or "") + [0], "<u4")
        for k, (s, n) in enumerate(P.cut(len(ids), 2048)):
            want[(i, k, s, n, zlib.crc32(ids[s: s + n].tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for off, n in sorted(held):
            assert off == at
            at += n
        assert at <= 2048
    assert len(bins) <= first_fit_decreasing([r["length"] for r in got])


def test_cut():
    assert P.cut(2048, 2048) == [(0, 2048)] and P.cut(2049, 2048) == [(0, 1), (1, 2048)] and P.cut(4096, 2048) == [(0, 2048), (2048, 2048)]


def test_empty_table(spark):
    assert P.best_two_fit(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_rows_of_one_id_and_text(spark):
    """No rows are told apart by id or text: places are still all different."""
    docs = spark.range(3000).selectExpr("cast(null as long) doc_id", "case when id < 2000 then 'the same words' else concat('word ', id) end text").repartition(5)
    got = P.best_two_fit(docs, 64).toPandas()
    assert len(got) == 3000 and not got.duplicated(["sequence_id", "offset"]).any()
    by = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert (by["offset"].min() == 0).all() and (by["length"].sum() <= 64).all()
    assert all((g["offset"].to_numpy()[1:] == (g["offset"] + g["length"]).to_numpy()[:-1]).all() for _, g in by)
    assert got["sequence_id"].nunique() <= -(-int(got["length"].sum()) // 64) + 1


def test_a_worker_encodes_a_slice_of_a_batch(spark, monkeypatch):
    """However many rows come together, their texts and pieces are held for a few hundred at a time."""
    class Narrow:
        def batch(self, texts):
            assert len(texts) <= 512
            return [np.zeros(len(t), np.uint32) for t in texts]

    monkeypatch.setattr(P, "encoder", lambda *a, **k: Narrow())
    docs = spark.range(3000).selectExpr("id doc_id", "repeat('a', cast(id % 7 as int)) text").coalesce(1)
    got = P.pieces(docs).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000)) and all(r["length"] == r["doc_id"] % 7 + 1 for r in got)
    assert Counter(r["nth"] for r in got if r["length"] == 3) == Counter(range(429))             # numbered across slices


def test_an_encoder_splits_few_signs_at_once(monkeypatch, reference):
    from citylens.llm import tokens

    seen, split = [], tokens.coded
    monkeypatch.setattr(tokens, "coded", lambda lists, table: seen.append(len(lists.flatten())) or split(lists, table))
    texts = [f"word{i} and some others\n" + "more of it " * 40 + "." for i in range(6000)]          # 2.8 million signs
    assert [ids.tolist() for ids in Encoder(vocabulary()).batch(texts)][::500] == [reference(t) for t in texts[::500]]
    assert len(seen) > 2 and max(seen) < 300_000
