"""I-Match fingerprints over several randomised lexicons.

The lexicon is the terms whose inverse document frequency over *all* documents
lies in a band: neither words of every text nor rare ones.  A text's distinct
lexicon terms, sorted, are hashed once per lexicon subset; subset 0 is the whole
lexicon (the classic signature), the others keep a term with probability 1/2,
1/4, ... 1/2048, three of each.  A fingerprint is the row of these signatures;
the likeness of two is the share of equal ones among those not empty on both
sides.  Small subsets tell long texts apart by degree, large ones short texts.

The lexicon is broadcast up to ``LEXICON_MOST`` terms.  Every document holds each
term once, so at most ``mean distinct terms * exp(IDF_MAX)`` terms reach the band,
which rarely is more.  Beyond it the lexicon stays a table: the distinct terms of
each text are joined with it, with the same fingerprints.

The terms of a text that holds a large part of the rows, or of its near copies,
leave the band with it.  A text that has less than a quarter of its distinct terms
in the lexicon is therefore signed over all of them, the same way; where one of
two texts is, their likeness is that of both signed so.

Rows are dealt into equal ranges of (id, hash of the text, place), so rows without
an id or of one id are spread like others; of each range only the first and the last
row meet those of the next.

Defined results: a null text is empty; a text without any term is fingerprinted
by the whole text (so equal texts are always equal); with a null id a row comes
first in the order; rows of equal id follow each other by the hash of their text;
after the last row comes the first; an empty table gives an empty one; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string
from xxhash import xxh32_intdigest, xxh64_intdigest

from .common import held, keep, pick, texts_of
from .tokens import Pieces, by_size, coded

IDF_MIN = 1.5
IDF_MAX = math.log(500)
#: chance of a term to be in each lexicon subset
RATES = (1.0, *(2.0 ** -(1 + j // 3) for j in range(33)))
LEXICON_MOST = 4_000_000
#: bytes of text in a range of rows
RANGE_BYTES = 64 << 20
#: terms outside the lexicon that a worker holds
_OTHERS = 50_000
#: terms a counting task holds before it passes its counts on
_FLUSH = 400_000
_TERM = re.compile(r"\w+")


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


def _words(texts: list[str]):
    return pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))


def _distinct(values: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, value), each pair once, sorted."""
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pairs = np.unique(rows * size + values)
    return pairs // size, pairs % size


class _Numbered:
    """Gives terms numbers as they turn up; for ``Pieces``."""

    def __init__(self):
        self.terms: dict[str, int] = {}
        self.table = Pieces(self._new, np.int64)

    def _new(self, pieces):
        lists = [[self.terms.setdefault(t, len(self.terms)) for t in terms(p)] for p in pieces]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((n for x in lists for n in x), np.int64, int(counts.sum())), counts


def document_frequencies(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df) over all documents."""
    def run(batches):
        book, total = _Numbered(), np.zeros(0, np.int64)

        def out():
            names = list(book.terms)
            for at in range(0, len(names), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(names[at: at + 100_000]), pa.array(total[at: at + 100_000])], names=["term", "df"])

        for b in batches:
            texts = texts_of(b)
            for i, j in by_size(texts):
                values, offsets = coded(_words(texts[i:j]), book.table)
                _, found = _distinct(values, offsets, max(1, len(book.terms)))
                total = np.concatenate([total, np.zeros(len(book.terms) - len(total), np.int64)]) + np.bincount(found, minlength=len(book.terms))
                if len(total) > _FLUSH:
                    yield from out()
                    book, total = _Numbered(), np.zeros(0, np.int64)
        yield from out()

    return pick(docs, text=text_col).mapInArrow(run, "term string, df long").groupBy("term").agg(F.sum("df").alias("df"))


class Lexicon:
    """Terms of the band in order, and which subsets they are in."""

    def __init__(self, names: list[str], rates=RATES):
        self.names = sorted(names)
        self.rates = rates

    def prepare(self) -> Lexicon:
        """In the worker: numbers, hashes and subset bits of the terms."""
        self.number = {t: i for i, t in enumerate(self.names)}
        self.hashes = np.fromiter((xxh64_intdigest(t) for t in self.names), np.uint64, len(self.names))
        self.member = [np.fromiter((xxh64_intdigest(t, 1 + j) < r * 2**64 for t in self.names), bool, len(self.names))
                       for j, r in enumerate(self.rates)]
        self.table = Pieces(self._new, np.int64)
        self.others: dict[str, tuple[int, int]] = {}
        return self

    def over_all(self, text: str) -> np.ndarray:
        """Signatures over all distinct terms of a text."""
        return self.over(sorted(set(terms(text))))

    def over(self, own: list[str]) -> np.ndarray:
        """Signatures over terms, which come sorted and once each."""
        if len(self.others) > _OTHERS:
            self.others = {}
        for t in own:
            if t not in self.others:
                self.others[t] = (xxh64_intdigest(t), sum((xxh64_intdigest(t, 1 + j) < r * 2**64) << j for j, r in enumerate(self.rates)))
        hashes, bits = (np.fromiter((self.others[t][k] for t in own), np.uint64, len(own)) for k in (0, 1))
        out = np.zeros(len(self.rates), np.uint32)
        for j in range(len(self.rates)):
            if data := hashes[(bits >> np.uint64(j)) & np.uint64(1) == 1].tobytes():
                out[j] = xxh32_intdigest(data, j) or 1
        return out

    def _new(self, pieces):
        lists = [[self.number[t] for t in terms(p) if t in self.number] for p in pieces]
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((n for x in lists for n in x), np.int64, int(counts.sum())), counts

    def signatures(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, subsets) of unsigned 32-bit hashes, 0: no term in the subset;
        and which texts are signed over all their terms."""
        out, over_all = np.zeros((len(texts), len(self.rates)), np.uint32), np.zeros(len(texts), bool)
        for a, b in by_size(texts):
            words = _words(texts[a:b])
            values, offsets = coded(words, self.table)
            row, term = _distinct(values, offsets, max(1, len(self.names)))
            for j, member in enumerate(self.member):
                inside = member[term]
                data = self.hashes[term[inside]].tobytes()
                ends = np.cumsum(np.bincount(row[inside], minlength=b - a)) * 8
                start = 0
                for i, end in enumerate(ends.tolist()):
                    if end > start:
                        out[a + i, j] = xxh32_intdigest(data[start:end], j) or 1
                    start = end
            known = np.bincount(row, minlength=b - a)
            for i in np.flatnonzero(4 * known < np.diff(words.offsets.to_numpy())):
                if 4 * known[i] < len(own := sorted(set(terms(texts[a + i])))):
                    out[a + i], over_all[a + i] = self.over(own), True
            for i in np.flatnonzero((known == 0) & ~over_all[a:b]):
                out[a + i] = self.whole(texts[a + i])
        return out, over_all

    def whole(self, text: str) -> list[int]:
        data = text.encode("utf-8", "surrogatepass")
        return [xxh32_intdigest(data, 1000 + j) or 1 for j in range(len(self.rates))]

    def signed(self, texts: list[str], known: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """``signatures``, given the terms of each text that are in the lexicon."""
        out, over_all = np.zeros((len(texts), len(self.rates)), np.uint32), np.zeros(len(texts), bool)
        for i, (text, inside) in enumerate(zip(texts, known, strict=True)):
            own = set(terms(text))
            over_all[i] = 4 * len(inside) < len(own)
            out[i] = self.over(sorted(own if over_all[i] else inside)) if own else self.whole(text)
        return out, over_all

    def alike(self, texts: list[str], mine, others: list[str], theirs) -> np.ndarray:
        """Likeness of texts and others, given what ``signatures`` gave for each."""
        out = likeness(mine[0], theirs[0])
        for i in np.flatnonzero(mine[1] != theirs[1]):
            out[i] = likeness(*(s[0][i: i + 1] if s[1][i] else self.over_all(t[i])[None] for t, s in ((texts, mine), (others, theirs))))[0]
        return out


def band(docs: DataFrame, idf_min: float = IDF_MIN, idf_max: float = IDF_MAX, text_col: str = "text") -> DataFrame:
    """(term) whose idf, ln(documents / df), is in the band; written."""
    n = docs.count()
    most, least = n * math.exp(-idf_min), n * math.exp(-idf_max)
    return keep(document_frequencies(docs, text_col).where(F.col("df").between(least, most)).select("term"), "lexicon")


def lexicon(docs: DataFrame, idf_min: float = IDF_MIN, idf_max: float = IDF_MAX, text_col: str = "text") -> Lexicon | DataFrame:
    """The terms of the band, as a table if they are more than ``LEXICON_MOST``."""
    found = band(docs, idf_min, idf_max, text_col)
    return Lexicon([r["term"] for r in found.toLocalIterator()]) if found.count() <= LEXICON_MOST else found


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal signatures per row, of those present on either side."""
    used = (a != 0) | (b != 0)
    return ((a == b) & used).sum(axis=1) / np.maximum(1, used.sum(axis=1))


def _packed(signatures: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in signatures.astype(">u4")]


def hexed(signatures: np.ndarray) -> list[str]:
    return [r.hex() for r in _packed(signatures)]


def _in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in equal ranges of the order, each sorted.  Rows that are
    the same in id and text are told apart by their place alone."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    placed = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.monotonically_increasing_id().alias("row"))
    return placed.repartitionByRange(parts, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text")


def _consecutive(docs: DataFrame, each, schema: str) -> DataFrame:
    """``each`` over runs of the rows in order: a list of (doc_id, text) gives a
    dict of columns with a row for all but the last.  The first and the last row
    of every range are kept aside and run over afterwards, two per range."""
    fields = to_arrow_schema(_parse_datatype_string(schema))
    names, kinds = fields.names, fields.types

    def out(run):
        found = each(run)
        empty = [None] * (len(run) - 1)
        return pa.RecordBatch.from_arrays([*(pa.array(found[n]) for n in names), pa.array(empty, pa.int64()), pa.array(empty, pa.int64()),
                                           pa.array(empty, pa.string())], names=[*names, "edge", "edge_id", "edge_text"])

    def aside(edge, row):
        return pa.RecordBatch.from_arrays([*(pa.array([None], k) for k in kinds), pa.array([edge], pa.int64()), pa.array([row[0]], pa.int64()),
                                           pa.array([row[1]], pa.string())], names=[*names, "edge", "edge_id", "edge_text"])

    def within(batches):
        part, last = TaskContext.get().partitionId(), None
        for b in batches:
            rows = list(zip(b.column("doc_id").to_pylist(), texts_of(b), strict=True))
            if not rows:
                continue
            if last is None:
                yield aside(2 * part, rows[0])
            run = rows if last is None else [last, *rows]
            if len(run) > 1:
                yield out(run)
            last = rows[-1]
        if last is not None:
            yield aside(2 * part + 1, last)

    def between(batches):
        first = last = None
        for b in batches:
            for edge, doc_id, text in zip(*(b.column(c).to_pylist() for c in ("edge", "edge_id", "edge_text")), strict=True):
                if edge % 2:
                    last = (doc_id, text)
                elif first is None:
                    first = (doc_id, text)
                else:
                    yield out([last, (doc_id, text)])
        if last is not None:
            yield out([last, first])

    kind = f"{schema}, edge long, edge_id long, edge_text string"
    done = keep(_in_order(docs).mapInArrow(within, kind), "consecutive")
    edges = done.where("edge is not null").coalesce(1).sortWithinPartitions("edge")
    return done.where("edge is null").select(*names).unionByName(edges.mapInArrow(between, kind).select(*names))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_SIGNED = "doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _columns(book: Lexicon, ids, texts, edited, following, mine, changed, next_one) -> dict:
    return {"doc_id": pa.array(ids, pa.int64()), "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(e.encode("utf-8", "surrogatepass")).digest() for e in edited],
            "fingerprint": _packed(mine[0]), "edited_fingerprint": _packed(changed[0]),
            "near_edited": book.alike(texts, mine, edited, changed), "near_next": book.alike(texts, mine, following, next_one)}


def _by_broadcast(own: DataFrame, words: Lexicon) -> DataFrame:
    shared, name = own.sparkSession.sparkContext.broadcast(words), uuid4().hex

    def each(run):
        book = held(f"lexicon-{name}", "", lambda: shared.value.prepare())
        ids, texts = ([r[k] for r in run] for k in (0, 1))
        edited = [_edited(a, b) for a, b in zip(texts, texts[1:])]
        every, changed = book.signatures(texts), book.signatures(edited)
        mine, next_one = tuple(x[:-1] for x in every), tuple(x[1:] for x in every)
        return _columns(book, ids[:-1], texts[:-1], edited, texts[1:], mine, changed, next_one)

    return _consecutive(own, each, _SIGNED)


def _by_join(own: DataFrame, words: DataFrame) -> DataFrame:
    """The same with a lexicon that is a table of any size."""
    roles = ("text", "edited", "following")

    def each(run):
        texts = [r[1] for r in run]
        return {"uid": [uuid4().hex for _ in run[1:]], "doc_id": pa.array([r[0] for r in run[:-1]], pa.int64()), "text": texts[:-1],
                "edited": [_edited(a, b) for a, b in zip(texts, texts[1:])], "following": texts[1:]}

    def spell(batches):
        for b in batches:
            for uid, role, text in zip(b.column("uid").to_pylist(), b.column("role").to_pylist(), texts_of(b), strict=True):
                if found := list(set(terms(text))):
                    yield pa.RecordBatch.from_arrays([pa.array([uid] * len(found)), pa.array([role] * len(found)), pa.array(found)], names=["uid", "role", "term"])

    def sign(batches):
        book = held("lexicon-joined", "", lambda: Lexicon([]).prepare())
        for b in batches:
            ids, sides = b.column("doc_id").to_pylist(), [texts_of(b, r) for r in roles]
            signed = [book.signed(side, [k or [] for k in b.column(f"in_{r}").to_pylist()]) for r, side in zip(roles, sides, strict=True)]
            found = _columns(book, ids, *sides, *signed)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in found.values()], names=list(found))

    rows = keep(_consecutive(own, each, "uid string, doc_id long, text string, edited string, following string"), "neighbours")
    sides = rows.select("uid", F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("text")) for r in roles])).alias("s")).select("uid", "s.*")
    inside = sides.mapInArrow(spell, "uid string, role string, term string").join(words.select("term"), "term", "left_semi")
    known = inside.groupBy("uid").agg(*[F.collect_list(F.when(F.col("role") == r, F.col("term"))).alias(f"in_{r}") for r in roles])
    return rows.join(known, "uid", "left").drop("uid").mapInArrow(sign, _SIGNED)


def fingerprint_edits(docs: DataFrame, words: Lexicon | DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document against its edited text -- the last half of the code points
    replaced by the first as many of the next document's -- and against the next.
    ``words``: the lexicon, broadcast, or as a table (term) of any size."""
    own = pick(docs, doc_id=id_col, text=text_col)
    words = lexicon(own) if words is None else words
    found = _by_broadcast(own, words) if isinstance(words, Lexicon) else _by_join(own, words)
    return found.select("doc_id", "n_chars", *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                        "near_edited", "near_next")
