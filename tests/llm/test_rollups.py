import random

import pytest

from citylens.llm import rollups as R

EVENT = ("op string, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, old_tokenizer string, "
         "old_tokens long, n_docs string")


def events(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], EVENT)


def brute(batches):
    out = {}
    for op, s, la, t, n, os, ol, ot, on in (e for b in batches for e in b):
        for key, sign, count in {"insert": [((s, la, t), 1, n)], "delete": [((s, la, t), -1, n)], "revise": [((os, ol, ot), -1, on), ((s, la, t), 1, n)]}[op]:
            d, k = out.get(key, (0, 0))
            out[key] = (d + sign, k + sign * (count or 0))
    return {k: v for k, v in out.items() if v != (0, 0)}


def totals(r):
    return {(x["source"], x["lang"], x["tokenizer"]): (x["n_docs"], x["n_tokens"]) for x in r.totals().collect()}


def test_batches_replays_and_snapshots(spark, tmp_path):
    rnd = random.Random(8)
    pick = lambda: (rnd.choice(["a", "b", None]), rnd.choice(["en", "fr"]), rnd.choice(["t1", "t2"]), rnd.choice([None, 0, 5, 70]))
    made = [[(rnd.choice(["insert", "delete", "revise"]), *pick(), *pick()) for _ in range(80)] for _ in range(3)] + [[]]
    r = R.Rollup(spark, str(tmp_path / "roll"))
    assert totals(r) == {} and r.batches().count() == 0
    for i, b in enumerate(made):
        assert r.commit(f"b{i}", R.signed(events(spark, b)))
        assert totals(r) == brute(made[: i + 1])
        assert not r.commit(f"b{i}", R.signed(events(spark, made[0])))          # idempotent
        if i == 1:
            r.compact()
            assert not r.commit("b0", R.signed(events(spark, made[0])))
            assert totals(r) == brute(made[:2])
    r.compact()
    again = R.Rollup(spark, str(tmp_path / "roll"))
    assert totals(again) == brute(made) and sorted(x["id"] for x in again.batches().collect()) == ["b0", "b1", "b2", "b3"]
    left = [p.name for p in (tmp_path / "roll/batches").iterdir()]
    assert left == [] and len(list((tmp_path / "roll/snapshots").iterdir())) == 2


def test_a_batch_that_broke_off_does_not_count(spark, tmp_path):
    r = R.Rollup(spark, str(tmp_path / "roll"))
    e = [("insert", "a", "en", "t", 5, None, None, None, None)]
    r.commit("x", R.signed(events(spark, e)))
    (tmp_path / "roll/batches/id=x/_SUCCESS").unlink()                          # as a lost driver leaves it
    assert totals(r) == {}
    assert r.commit("x", R.signed(events(spark, e))) and totals(r) == {("a", "en", "t"): (1, 5)}


def test_unknown_events_and_ids_are_errors(spark, tmp_path):
    with pytest.raises(Exception, match="no such kind"):
        R.signed(events(spark, [("drop", "a", "en", "t", 5, None, None, None, None)])).collect()
    with pytest.raises(ValueError):
        R.Rollup(spark, str(tmp_path)).commit("a/b", R.signed(events(spark, [])))


def test_counts_against_the_tokenizer(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "Hello  world é", "a", "en"), (1, None, None, "fr"), (None, "x\ny", "a", None)]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, lang string, tokens int")
    got = R.token_counts(docs, {"v1": public_tokenizers.path("byte_bpe_50k.json"), "v2": public_tokenizers.path("byte_bpe_multi_50k.tiktoken")}).collect()
    assert len(got) == 6 and all(r["tokens"] > 0 or r["source"] is None for r in got)
    assert sorted(r["tokens"] for r in got if r["tokenizer"] == "v1") == sorted(len(hf.encode(t or "", add_special_tokens=False).ids) for _, t, _, _ in rows)


def test_query_against_brute_force(spark):
    from collections import Counter

    import public_tokenizers
    import tiktoken

    from citylens.llm.queries import op4_token_counts
    from citylens.llm.tokens import vocabulary
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    bpe = [tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(public_tokenizers.path(f)), special_tokens={})
           for f in ("byte_bpe_multi_50k.tiktoken",)][0]
    first, want, tokens = {}, Counter(), Counter()
    for d in docs:
        first[d["text"]] = min(first.get(d["text"], d["doc_id"]), d["doc_id"])
    for d in docs:
        if first[d["text"]] == d["doc_id"]:
            want[d["source"], d["lang"]] += 1
            tokens[d["source"], d["lang"]] += len(bpe.encode_ordinary(d["text"]))
    got = op4_token_counts(spark, sf).collect()
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in got} == {k: (want[k], tokens[k]) for k in want}
    assert {r["tokenizer"] for r in got} == {"byte_bpe_multi_50k"}


def test_copies_among_repeated_rows_and_rows_without_id(spark, tmp_path):
    """All but the first row of a text go, whatever the ids."""
    from collections import Counter

    import public_tokenizers
    import tiktoken

    from citylens.llm.queries import op4_token_counts
    from citylens.llm.tokens import vocabulary
    rows = [(1, "one text", "en", "a"), (1, "one text", "en", "a"), (None, "two", "en", "a"), (None, "two", "en", "a"), (None, "two", None, "b"),
            (5, "three", "fr", None), (None, "three", "en", "a"), (4, "three", "en", "b"), (7, None, "en", "a"), (8, "", "en", "b"), (2, "one text", "fr", "b"),
            (9, "alone", None, None)]
    spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    bpe = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    first = {}
    for r in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[3] is not None, r[3] or "", r[2] is not None, r[2] or "")):
        first.setdefault(r[1] or "", r)
    docs, tokens = Counter(), Counter()
    for text, r in first.items():
        docs[r[3], r[2]] += 1
        tokens[r[3], r[2]] += len(bpe.encode_ordinary(text))
    got = op4_token_counts(spark, str(tmp_path)).collect()
    assert {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in got} == {k: (docs[k], tokens[k]) for k in docs}
