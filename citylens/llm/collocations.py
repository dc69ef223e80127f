"""Phrase collocations of each language, mined with count transducers.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into
words at spaces and tabs.  ``f`` of a phrase of up to three words is how often it occurs
within pieces.  A candidate has two or three words and ``f >= LEAST``; a cut into two parts
scores ``floor(10^6 f^2 / (f(part) f(rest)))`` and the worst cut counts.  A candidate that a longer
one contains is dropped if the longer one is at least ``SHARE`` percent as frequent.

1. Each task builds count transducers of its shard, piece by piece, and cuts
   them into the ranges of their prefixes (``transducers.cut``).
2. Each (language, range) sums its transducers.  What weighs less than ``LEAST``
   goes: no candidate and no part of one is that rare.
3. The parts of a range's candidates are asked of the ranges that hold them: the
   transducer of the parts is composed with the one that holds the counts.  A part is asked
   once per asking range, however many candidates have it.  A pair is asked with the
   weight of the most frequent candidate that ends in it.
4. Each range scores its candidates and keeps its best ``TOP``; ``FAN`` ranges
   of a language are ranked together, then ``FAN`` of those results, until one
   is left: no task ranks more than ``FAN * TOP`` rows of a language.

The number of ranges follows the bytes of all texts, so a task's share stays the same
at any size, and a prefix is two words long, so a frequent word or language is spread
over many ranges.  A null text is empty, a null language is ``und``; repeated
rows and null ids count each; an empty table gives an empty one; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import transducers as T
from .common import keep, pick, release

#: least occurrences of a candidate
LEAST = 10
#: percent of a candidate's occurrences from which a longer one replaces it
SHARE = 50
#: candidates reported per language
TOP = 2000
#: bytes of text whose phrases are summed in one group
RANGE_BYTES = 1 << 25
#: ranges whose best candidates are ranked in one task
FAN = 256
#: words of a shard that are sorted together, about; different words among them; words coded at once
_TOKENS = 3_000_000
_WORDS = 1 << 20
_STRETCH = 1_000_000
_ROWS = "lang string, range int, asked_by int, kind int, counts binary, n long"
_SHARD = "lang string, range int, counts binary"

_TABLE = bytes(ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
OWN, ASKED, ANSWER, INSIDE = range(4)


def words_of(text: bytes) -> list[bytes]:
    """Words of a text, ``.`` between pieces (no word holds one)."""
    return text.translate(_TABLE).replace(b".", b" . ").split()


class _Numbers(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _rows(rows: list[tuple], names: list[str], types: list[pa.DataType]):
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def shards(docs: DataFrame, ranges: int, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, range, counts): transducers of the shards, cut into ranges."""
    def run(batches):
        release()
        open_: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        size = 0

        def flush():
            for lang, (number, codes) in open_.items():
                for r, part in T.cut(T.from_codes(np.concatenate(codes), list(number)), ranges):
                    yield from _rows([(lang, r, T.to_bytes(part))], ["lang", "range", "counts"], [pa.string(), pa.int32(), pa.binary()])
            open_.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                words = words_of(text or b"")
                for at in range(0, len(words), _STRETCH):
                    number, codes = open_.setdefault(lang, (_Numbers({b".": 0}), []))
                    some = words[at: at + _STRETCH + 2]             # two words of the next stretch end the last phrases
                    code = np.fromiter(map(number.__getitem__, some), np.int64, len(some))
                    code[_STRETCH:] *= -1
                    codes += [code, _STOP]
                    size += len(some)
                    if size > _TOKENS or len(number) > _WORDS:
                        yield from flush()
                        size = 0
        yield from flush()

    own = pick(docs, lang=lang_col, text=text_col)
    return own.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").mapInArrow(run, _SHARD)


_STOP = np.zeros(1, np.int64)


def _parts(c: T.Counts, ranges: int):
    """(range, transducer) of the parts of the candidates of ``c`` that other ranges may hold."""
    ends = np.stack([c.two[c.parent, 1], c.three], axis=1)
    key = ends[:, 0] * (len(c.words) + 1) + ends[:, 1]
    order = np.lexsort((-c.f3, key))
    first = np.append(True, np.diff(key[order]) != 0)[: len(order)]
    order = order[first]                                            # the most frequent candidate of each ending
    one = np.unique(np.concatenate([c.two.ravel(), c.three]))
    asked = T.narrow(T.Counts(c.words, one, np.zeros(len(one), np.int64), ends[order], c.f3[order], *[np.zeros(0, np.int64)] * 3))
    return T.cut(asked, ranges)


def summed(parts: DataFrame, ranges: int, least: int = LEAST) -> DataFrame:
    """The counts of each (lang, range) and what it asks of others."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, r = key[0].as_py(), key[1].as_py()
        total = T.Adding()
        for b in batches:
            for data in b.column("counts"):
                total.add(T.from_bytes(data.as_py()))
        whole = total.total()
        own = T.at_least(whole, least)
        rows = [(lang, r, r, OWN, T.to_bytes(own), int(whole.f1.sum()))]
        rows += [(lang, to, r, ASKED, T.to_bytes(part), None) for to, part in _parts(own, ranges)]
        yield from _rows(rows, ["lang", "range", "asked_by", "kind", "counts", "n"], [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()])

    return parts.groupBy("lang", "range").applyInArrow(run, _ROWS)


def answered(rows: DataFrame) -> DataFrame:
    """Each range's counts, the answers to what was asked of it, and which of
    its pairs end a longer candidate (weight: the most frequent one's)."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, r = key[0].as_py(), key[1].as_py()
        own, asked = T.empty(), []
        for b in batches:
            for kind, by, data in zip(b.column("kind").to_pylist(), b.column("asked_by").to_pylist(), b.column("counts").to_pylist(), strict=True):
                if kind == OWN:
                    own = T.from_bytes(data)
                else:
                    asked.append((by, data))
        out, longest = [], np.zeros(len(own.two), np.int64)
        for by, data in asked:
            part = T.from_bytes(data)
            label = T.labels(own, part.words)
            at = T.places2(own, label[part.two[:, 0]], label[part.two[:, 1]])
            np.maximum.at(longest, at[at >= 0], part.f2[at >= 0])
            out.append((lang, by, r, ANSWER, T.to_bytes(T.compose(part, own)), None))
        inside = np.flatnonzero(longest)
        none = np.zeros(0, np.int64)
        out.append((lang, r, r, OWN, T.to_bytes(own), None))
        out.append((lang, r, r, INSIDE, T.to_bytes(T.narrow(T.Counts(own.words, none, none, own.two[inside], longest[inside], none, none, none))), None))
        yield from _rows(out, ["lang", "range", "asked_by", "kind", "counts", "n"], [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()])

    return rows.groupBy("lang", "range").applyInArrow(run, _ROWS)


def _floor(a: np.ndarray, l: np.ndarray, r: np.ndarray) -> np.ndarray:
    """floor(10^6 a^2 / (l r)) in whole numbers of any size."""
    if not len(a):
        return np.zeros(0, np.int64)
    x, y, z = (v.astype(object) for v in (a, l, r))
    return (1_000_000 * x * x // (y * z)).astype(np.int64)


def scored(rows: DataFrame, share: int = SHARE, top: int = TOP) -> DataFrame:
    """(lang, range, phrase, a, l, r, score): each range's best candidates."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, parts = {OWN: T.empty(), INSIDE: T.empty()}, T.Adding()
        for b in batches:
            for kind, data in zip(b.column("kind").to_pylist(), b.column("counts").to_pylist(), strict=True):
                if kind == ANSWER:
                    parts.add(T.from_bytes(data))
                else:
                    got[kind] = T.from_bytes(data)
        own, known = got[OWN], parts.total()
        f1 = T.weights1(known, own.words)
        a2, l2, r2 = own.f2, f1[own.two[:, 0]], f1[own.two[:, 1]]
        longest = T.weights2(got[INSIDE], own.words, own.two)
        np.maximum.at(longest, own.parent, own.f3)
        keep2 = 100 * longest < share * a2
        first, rest = own.two[own.parent], np.stack([own.two[own.parent, 1], own.three], axis=1)
        cuts = [(f1[first[:, 0]], T.weights2(known, own.words, rest)), (own.f2[own.parent], f1[own.three])]
        s = [_floor(own.f3, l, r) for l, r in cuts]
        second = s[1] < s[0]                                        # ties: the smallest cut
        a = np.concatenate([a2[keep2], own.f3])
        l = np.concatenate([l2[keep2], np.where(second, cuts[1][0], cuts[0][0])])
        r = np.concatenate([r2[keep2], np.where(second, cuts[1][1], cuts[0][1])])
        score = np.concatenate([_floor(a2[keep2], l2[keep2], r2[keep2]), np.where(second, s[1], s[0])])
        order = np.lexsort((-a, -score))
        if len(order) > top:                                        # and all that tie with the last
            e = order[top - 1]
            order = order[(score[order] > score[e]) | ((score[order] == score[e]) & (a[order] >= a[e]))]
        names = own.words.to_pylist()
        pairs, n2 = own.two[keep2], int(keep2.sum())
        phrase = [b" ".join((names[pairs[i, 0]], names[pairs[i, 1]])) if i < n2
                  else b" ".join((names[first[i - n2, 0]], names[first[i - n2, 1]], names[own.three[i - n2]])) for i in order.tolist()]
        best = sorted(zip((-score[order]).tolist(), (-a[order]).tolist(), phrase, order.tolist(), strict=True))[:top]
        at = np.array([x[3] for x in best], np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()] * len(at), pa.string()), pa.array([key[1].as_py()] * len(at), pa.int32()), pa.array([x[2].decode() for x in best], pa.string()),
             *[pa.array(v[at], pa.int64()) for v in (a, l, r, score)]], names=["lang", "range", "phrase", "a", "l", "r", "score"])

    return rows.groupBy("lang", "range").applyInArrow(run, "lang string, range int, phrase string, a long, l long, r long, score long")


def ranked(best: DataFrame, ranges: int, top: int = TOP, fan: int = FAN) -> DataFrame:
    """The best ``top`` rows of each language with their ``rank``, from those of
    its ranges, ``fan`` ranges at a time."""
    while True:
        ranges = -(-ranges // fan)
        order = Window.partitionBy("lang", "range").orderBy(F.desc("score"), F.desc("a"), "phrase")
        best = (best.withColumn("range", F.expr(f"int(range div {fan})")).withColumn("rank", F.row_number().over(order).cast("long"))
                .where(F.col("rank") <= top))
        if ranges <= 1:
            return best.drop("range")


def ranges_of(docs: DataFrame, text_col: str = "text", range_bytes: int = RANGE_BYTES) -> int:
    """Ranges that the bytes of all texts need."""
    total = pick(docs, text=text_col).agg(F.sum(F.octet_length("text").cast("long")).alias("b")).first()["b"]
    return 1 + (total or 0) // range_bytes


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, lang_col: str = "lang", text_col: str = "text",
                 range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` candidates of
    each language; a, l, r: occurrences of the phrase, of the first and of the
    second part of its worst cut; n: of all words of the language."""
    ranges = ranges_of(docs, text_col, range_bytes)
    sums = keep(summed(shards(docs, ranges, lang_col, text_col), ranges, least), "phrase-sums")
    n = sums.where(F.col("kind") == OWN).groupBy("lang").agg(F.sum("n").alias("n"))
    best = ranked(scored(answered(sums.drop("n")), share, top), ranges, top, fan)
    return best.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """The same by SQL: all phrases counted in one table."""
    from_, to = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return f"""
WITH pieces AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]'), lambda w: w <> '') AS words FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), '{from_}', '{to}'), '[.,;:!?\\n\\x0B\\x0C\\r]')) AS piece
    FROM documents)),
runs AS (SELECT lang, unnest(words) AS w1, unnest(list_append(words[2:], NULL)) AS w2,
                unnest(list_append(list_append(words[3:], NULL), NULL)[1:len(words)]) AS w3
         FROM pieces WHERE len(words) > 0),
f1 AS (SELECT lang, w1, count(*)::HUGEINT AS f FROM runs GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*)::HUGEINT AS f FROM runs WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*)::HUGEINT AS f FROM runs WHERE w3 IS NOT NULL GROUP BY ALL),
long_ AS (SELECT * FROM f3 WHERE f >= {LEAST}),
inside AS (SELECT lang, x, y, max(f) AS most FROM (
    SELECT lang, w1 AS x, w2 AS y, f FROM long_ UNION ALL SELECT lang, w2, w3, f FROM long_) GROUP BY ALL),
two AS (
  SELECT p.lang, p.w1 || ' ' || p.w2 AS phrase, p.f AS a, x.f AS l, y.f AS r
  FROM f2 p JOIN f1 x ON x.lang = p.lang AND x.w1 = p.w1 JOIN f1 y ON y.lang = p.lang AND y.w1 = p.w2
  LEFT JOIN inside s ON s.lang = p.lang AND s.x = p.w1 AND s.y = p.w2
  WHERE p.f >= {LEAST} AND (s.most IS NULL OR 100 * s.most < {SHARE} * p.f)),
cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3 AS phrase, 1 AS k, t.f AS a, x.f AS l, y.f AS r
  FROM long_ t JOIN f1 x ON x.lang = t.lang AND x.w1 = t.w1 JOIN f2 y ON y.lang = t.lang AND y.w1 = t.w2 AND y.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, 2, t.f, x.f, y.f
  FROM long_ t JOIN f2 x ON x.lang = t.lang AND x.w1 = t.w1 AND x.w2 = t.w2 JOIN f1 y ON y.lang = t.lang AND y.w1 = t.w3),
every AS (
  SELECT lang, phrase, 1 AS k, a, l, r, (1000000 * a * a) // (l * r) AS score FROM two
  UNION ALL SELECT lang, phrase, k, a, l, r, (1000000 * a * a) // (l * r) FROM cuts),
worst AS (SELECT * FROM every QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM worst)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r,
       (SELECT sum(f) FROM f1 WHERE f1.lang = ranked.lang)::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= {TOP}
"""
