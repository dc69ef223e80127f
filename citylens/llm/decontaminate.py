"""Benchmark decontamination by latent semantic retrieval.

Passages are windows of ``WINDOW`` words, one starting every ``STRIDE`` words of
every whole text, weighted by TF-IDF over the words of the benchmark (words it
lacks add nothing to a product with an item); document frequencies are counted
over all texts.  A randomised SVD gives the latent space: each task multiplies
its passages with a random matrix and back, and the sums meet in a tree of
bounded groups.  The space is fitted on the items and on all passages of all
documents, and every passage is searched.  The counts and the sums share one
reading of the texts: their benchmark words are written once as numbers (a few
bytes a word) and deleted when the space is fitted.

Passages whose cosine with an item reaches ``COSINE`` are candidates; passages
without a single answer word of any item cannot be the best ones of a leak and
are not projected.  A candidate is a leak if the longest common subsequence of
the item's words and the words around the passage, and the item's answer, are
there: a paraphrase keeps order and key words, a chance likeness does not.

The benchmark is the stated query set: it is held in blocks of ``BLOCK`` items,
searched against all rows one block after the other.  Nothing of the corpus
grows at the driver: it sees counts per benchmark word and one matrix of
benchmark words by ``RANK``.

Defined results: a null text or item is empty and leaks nothing; an item
without words is never found; items with equal words are found together; a null
id gets its own rows; repeated rows give repeated results; an empty table or
benchmark gives none; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .common import drop_kept, held, keep, pick, release, slices, texts_of
from .tokens import Pieces, by_size, gather

WINDOW = 32
STRIDE = 16
RANK = 128
COSINE = 0.5
#: least share of an item's words in order around a passage
ORDERED = 0.7
#: least share of the answer's words there (without an answer: of the item's rarest words)
ANSWERED = 0.6
#: items held at once
BLOCK = 4096
_WORD = re.compile(r"\w+")
#: words, and cells, taken at once: their rows of the space stay in a core's cache
_TOKENS, _CELLS = 1024, 4096
#: ASCII signs that no word holds
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^`{|}~"


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


@dataclass
class Items:
    """A block of benchmark items in numbers of its own words."""
    ids: list[int]
    vocabulary: list[str]
    codes: list[np.ndarray]
    answers: list[np.ndarray | None]
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    space: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))       # word by rank: idf times the singular directions
    latent: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))      # item by rank, unit length
    keys: list[np.ndarray] = field(default_factory=list)                      # words of the answer check


def items_of(rows: list[tuple[int, str | None, str | None]]) -> Items:
    lists = [(i, words(t or ""), words(a) if a else None) for i, t, a in rows]
    vocabulary = sorted({w for _, t, a in lists for w in [*t, *(a or [])]})
    number = {w: n for n, w in enumerate(vocabulary)}
    code = lambda ws: np.array([number[w] for w in ws], np.int64)
    return Items([i for i, _, _ in lists], vocabulary, [code(t) for _, t, _ in lists], [None if a is None else code(a) for _, _, a in lists])


class _Coder:
    """Texts as numbers of benchmark words, -1 for others, in order."""

    def __init__(self, vocabulary: list[str]):
        self.number = {w: n for n, w in enumerate(vocabulary)}
        self.vocabulary = pa.array(vocabulary, pa.large_string())
        self.table = Pieces(self._new, np.int64, 600_000)

    def _new(self, pieces):
        number, lists = self.number, []
        for p in pieces:
            one = p if p.isalnum() else p[:-1]                     # a word, maybe with a mark after it
            low = one.lower()
            if low.isalnum() and (one is p or not (p[-1].isalnum() or p[-1] == "_" or p[-1].lower() != p[-1])):
                lists.append((number.get(low, -1),))
            else:
                lists.append([number.get(w, -1) for w in words(p)])
        counts = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter((n for x in lists for n in x), np.int64, int(counts.sum())), counts

    def __call__(self, texts: list[str]):
        """(values, offsets): plain words -- ASCII letters and digits, maybe between
        marks -- are looked up in arrays, the rest one by one."""
        lists = pc.utf8_split_whitespace(pa.array(texts, pa.large_string()))
        offsets = lists.offsets.to_numpy().astype(np.int64)
        pieces = lists.flatten().dictionary_encode()
        core = pc.ascii_trim(pieces.dictionary, characters=_MARKS)
        plain = pc.ascii_is_alnum(core)
        number = pc.fill_null(pc.index_in(pc.ascii_lower(core), value_set=self.vocabulary), -1).to_numpy().astype(np.int64)
        plain = plain.to_numpy(zero_copy_only=False)
        odd = np.flatnonzero(~plain)
        starts, counts = np.arange(len(plain)), np.ones(len(plain), np.int64)
        if len(odd):
            starts[odd], counts[odd] = self.table.runs(self.table.numbers(pieces.dictionary.take(pa.array(odd)).to_pylist()))
            starts[odd] += len(plain)
        codes = pieces.indices.to_numpy()
        per = counts[codes]
        ends = np.concatenate([[0], np.cumsum(per)])
        return gather(np.concatenate([number, self.table.flat]), starts[codes], per), ends[offsets - offsets[0]]


def cells(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of STRIDE words, texts in order: (text, position of the first word
    in the batch), and the run of every word."""
    counts = -(-np.diff(offsets) // STRIDE)
    text = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[text] + nth * STRIDE
    return text, starts, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, offsets[-1])))


def _cell_sums(values: np.ndarray, cell: np.ndarray, n: int, space: np.ndarray) -> np.ndarray:
    """Sums of the words' rows of ``space`` over each of n cells; words come in the order of cells."""
    out = np.zeros((n, space.shape[1]), np.float32)
    for a in range(0, len(values), _TOKENS):
        own = cell[a: a + _TOKENS]
        first = np.flatnonzero(np.diff(own, prepend=-1))
        out[own[first]] += np.add.reduceat(space[values[a: a + _TOKENS]], first, axis=0)
    return out


def _windows(sums: np.ndarray, text: np.ndarray) -> np.ndarray:
    """A window is a cell and the next one of the same text."""
    out = sums.copy()
    same = np.flatnonzero(text[1:] == text[:-1])
    out[same] += sums[same + 1]
    return out


# ---- statistics over all passages --------------------------------------------------------

_CODED = "words binary, counts binary"


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Slices of an array as binary values."""
    at = np.ascontiguousarray(ends * values.itemsize, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(values))])


def _numbers(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The reverse: (values, ends)."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int32)
    size = np.dtype(kind).itemsize
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[at[0]: at[-1]].view(kind) if data is not None else np.zeros(0, kind)
    return values, ((at - at[0]) // size).astype(np.int64)


def coded(docs: DataFrame, items: Items) -> DataFrame:
    """A row per text: the numbers of its benchmark words in order, and how many
    of them each of its cells has."""
    kind = np.uint16 if len(items.vocabulary) < 1 << 16 else np.uint32

    def run(batches):
        release("passages")
        coder = _Coder(items.vocabulary)
        for b in slices(batches, 1024):
            texts = texts_of(b)
            for i, j in by_size(texts, 6_000_000):
                values, offsets = coder(texts[i:j])
                text, _, cell = cells(offsets)
                at = np.flatnonzero(values >= 0)
                counts = np.bincount(cell[at], minlength=len(text)).astype(np.uint8)       # at most STRIDE
                words_to = np.searchsorted(at, offsets - offsets[0])
                cells_to = np.searchsorted(text, np.arange(j - i + 1))
                yield pa.RecordBatch.from_arrays([_binary(values[at].astype(kind), words_to), _binary(counts, cells_to)], names=["words", "counts"])

    return docs.mapInArrow(run, _CODED)


def _batches(batches, items: Items):
    """(numbers of benchmark words, the cell of each, the text of each cell)."""
    kind = np.uint16 if len(items.vocabulary) < 1 << 16 else np.uint32
    for b in batches:
        values, words_to = _numbers(b.column("words"), kind)
        counts, cells_to = _numbers(b.column("counts"), np.uint8)
        lo = 0
        while lo < b.num_rows:                                     # as many texts as have about so many cells
            hi = max(lo + 1, int(np.searchsorted(cells_to, cells_to[lo] + _CELLS, side="right")) - 1)
            own = counts[cells_to[lo]: cells_to[hi]]
            yield (values[words_to[lo]: words_to[hi]].astype(np.int64), np.repeat(np.arange(len(own)), own),
                   np.repeat(np.arange(hi - lo), np.diff(cells_to[lo: hi + 1])))
            lo = hi


def passage_frequencies(docs: DataFrame, items: Items) -> tuple[int, np.ndarray]:
    """Number of cells of all texts (or ``coded`` ones), and in how many each benchmark word is."""
    d = len(items.vocabulary)
    passages = docs if "counts" in docs.columns else coded(docs, items)

    def run(batches):
        total = np.zeros(d + 1, np.int64)
        for values, cell, text in _batches(batches, items):
            again = np.zeros(len(values), bool)                    # the word has been in its cell before
            for k in range(1, STRIDE):
                again[k:] |= (values[k:] == values[:-k]) & (cell[k:] == cell[:-k])
            total[:d] += np.bincount(values[~again], minlength=d)
            total[d] += len(text)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "n"])

    out = np.zeros(d + 1, np.int64)
    for r in passages.mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():     # a row per benchmark word
        out[r["i"]] = r["n"]
    return int(out[d]), out[:d]


def _gram_times(docs: DataFrame, items: Items, probe: np.ndarray) -> np.ndarray:
    """A'A.probe for the matrix A of all passages of the texts (or ``coded``
    ones): word by rank, summed in a tree."""
    rows, rank = probe.shape
    passages = docs if "counts" in docs.columns else coded(docs, items)
    shared = passages.sparkSession.sparkContext.broadcast(probe.astype(np.float32))
    chunk = max(1, 65_536 // rank)
    fan = max(2, math.isqrt(max(4, passages.rdd.getNumPartitions())))
    schema = "chunk int, branch int, sums binary"

    def run(batches):
        from pyspark import TaskContext

        release("gram")
        total = np.zeros((rows, rank), np.float64)
        branch = TaskContext.get().partitionId() % fan
        weighted = shared.value * items.idf[:, None].astype(np.float32)
        for values, cell, text in _batches(batches, items):
            z = _windows(_cell_sums(values, cell, len(text), weighted), text)      # passages by rank
            back = z.copy()                                                # a word is in the window of its cell and of the one before
            same = np.flatnonzero(text[1:] == text[:-1]) + 1
            back[same] += z[same - 1]
            order = np.argsort(values, kind="stable")
            for a in range(0, len(order), _TOKENS):
                own = values[order[a: a + _TOKENS]]
                first = np.flatnonzero(np.diff(own, prepend=-1))
                total[own[first]] += np.add.reduceat(back[cell[order[a: a + _TOKENS]]], first, axis=0)
        total *= items.idf[:, None]
        for c, at in enumerate(range(0, rows, chunk)):
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([branch], pa.int32()), pa.array([total[at: at + chunk].tobytes()])],
                                             names=["chunk", "branch", "sums"])

    def added(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s.as_py(), np.float64) for s in group.column("sums"))
        return pa.table({"chunk": group.column("chunk")[:1], "branch": pa.array([0], pa.int32()), "sums": pa.array([total.tobytes()])})

    parts = passages.mapInArrow(run, schema).groupBy("chunk", "branch").applyInArrow(added, schema)
    out = np.zeros((rows, rank))
    for r in parts.groupBy("chunk").applyInArrow(added, schema).collect():             # word by rank numbers together
        got = np.frombuffer(r["sums"], np.float64).reshape(-1, rank)
        out[r["chunk"] * chunk: r["chunk"] * chunk + len(got)] = got
    return out


def _items_times(items: Items, probe: np.ndarray) -> np.ndarray:
    """B'B.probe for the matrix B of the items (rows of unit length), from their
    words alone: no item by word matrix is made."""
    d = len(items.vocabulary)
    sizes = np.array([len(c) for c in items.codes], np.int64)
    item = np.repeat(np.arange(len(sizes)), sizes)
    key, count = np.unique(item * d + np.concatenate([*items.codes, np.zeros(0, np.int64)]), return_counts=True)
    item, word = key // d, key % d
    weight = count * items.idf[word]
    weight /= np.sqrt(np.maximum(np.bincount(item, weight ** 2, len(sizes)), 1e-24))[item]

    def times(rows, cols, n, matrix):
        """Sparse product: rows in order; a few thousand entries at a time."""
        out = np.zeros((n, matrix.shape[1]))
        for a in range(0, len(rows), _TOKENS):
            r = rows[a: a + _TOKENS]
            first = np.flatnonzero(np.diff(r, prepend=-1))
            out[r[first]] += np.add.reduceat(matrix[cols[0][a: a + _TOKENS]] * cols[1][a: a + _TOKENS, None], first, axis=0)
        return out

    z = times(item, (word, weight), len(sizes), probe)
    by = np.argsort(word, kind="stable")
    return times(word[by], (item[by], weight[by]), d, z)


def fit_space(docs: DataFrame, items: Items, rank: int = RANK, seed: int = 11) -> Items:
    """Fills in idf, latent space and items' places from all passages of ``docs`` (column text)."""
    d = len(items.vocabulary)
    passages = keep(coded(docs, items), "passages")
    n, df = passage_frequencies(passages, items)
    items.idf = np.log((n + 1) / (df + 1)) + 0.1
    rank = min(rank, d)
    probe = np.random.default_rng(seed).standard_normal((d, rank))
    corpus = _gram_times(passages, items, probe)
    drop_kept(passages)
    # items weigh as much as all passages together: the space must hold both
    own = _items_times(items, probe)
    y = corpus + math.sqrt((corpus ** 2).sum() / max(1e-12, (own ** 2).sum())) * own
    del corpus, own
    # symmetric one-pass SVD: G ~ Y (P'Y)^-1 Y', G = A'A of passages and items
    core = probe.T @ y
    values, turned = np.linalg.eigh((core + core.T) / 2)
    held = values > 1e-6 * max(values.max(), 1e-12)
    basis = np.linalg.svd(y @ (turned[:, held] / np.sqrt(values[held])), full_matrices=False)[0]      # right singular vectors of A
    items.space = (basis * items.idf[:, None]).astype(np.float32)
    latent = np.stack([items.space[c].sum(axis=0) for c in items.codes])
    items.latent = (latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)).astype(np.float32)
    for codes, answer in zip(items.codes, items.answers, strict=True):
        distinct = np.unique(codes)
        rare = distinct[np.argsort(-items.idf[distinct], kind="stable")][: max(3, len(distinct) // 4)]
        items.keys.append(rare if answer is None else np.unique(answer))
    return items


# ---- search ---------------------------------------------------------------------------------

def common_subsequence(masks: dict[int, int], n: int, region: list[int]) -> int:
    """Length of the longest common subsequence of an item of n words (bit masks
    of the places of each word) and a region, by bit-parallel rows."""
    full, row = (1 << n) - 1, (1 << n) - 1
    for w in region:
        m = masks.get(w)
        if m:
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


class Search:
    """Leaks of a batch of texts, in a worker."""

    def __init__(self, items: Items, cosine: float = COSINE, ordered: float = ORDERED, answered: float = ANSWERED):
        self.items, self.cosine, self.ordered, self.answered = items, cosine, ordered, answered
        self.coder = _Coder(items.vocabulary)
        self.masks = []
        for codes in items.codes:
            m: dict[int, int] = {}
            for place, w in enumerate(codes.tolist()):
                m[w] = m.get(w, 0) | 1 << place
            self.masks.append(m)
        self.keys = [set(k.tolist()) for k in items.keys]
        self.is_key = np.zeros(len(items.vocabulary) + 1, bool)        # the last place is that of -1
        self.is_key[np.concatenate([*items.keys, np.zeros(0, np.int64)])] = True
        self.candidates = 0

    def checked(self, item: int, region: list[int]) -> tuple[float, float] | None:
        """(ordered share, answered share) if the region holds the item."""
        n, keys = len(self.items.codes[item]), self.keys[item]
        there = keys.intersection(region)
        answered = len(there) / len(keys) if keys else 0.0
        if not n or answered < self.answered:
            return None
        share = common_subsequence(self.masks[item], n, region) / n
        return (share, answered) if share >= self.ordered else None

    def __call__(self, texts: list[str]) -> list[list[tuple[int, float, float, float]]]:
        """Per text: (item, cosine, ordered share, answered share), best passage of each item."""
        out: list[list] = []
        for i, j in by_size(texts, 6_000_000):
            out += self._block(texts[i:j])
        return out

    def _block(self, texts):
        found: list[dict] = [{} for _ in texts]
        values, offsets = self.coder(texts)
        text, starts, cell = cells(offsets)
        same = text[1:] == text[:-1]
        keyed = np.zeros(len(text), bool)
        keyed[cell[self.is_key[values]]] = True
        wanted = keyed.copy()                                          # windows with an answer word
        wanted[:-1] |= keyed[1:] & same
        needed = wanted.copy()                                         # and the cells they are made of
        needed[1:] |= wanted[:-1] & same
        at = np.flatnonzero((values >= 0) & needed[cell])
        place = np.cumsum(needed) - 1
        sums = _cell_sums(values[at], place[cell[at]], int(needed.sum()), self.items.space)
        windows = np.flatnonzero(wanted)
        z = sums[place[windows]]
        two = np.flatnonzero(np.append(same, False)[windows])
        z[two] += sums[place[windows[two]] + 1]
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
        for a in range(0, len(z), 8192):
            near = z[a: a + 8192] @ self.items.latent.T
            win, item = np.nonzero(near >= self.cosine)
            self.candidates += len(win)
            for w, it, c in zip(windows[win + a].tolist(), item.tolist(), near[win, item].tolist(), strict=True):
                t = int(text[w])
                n = len(self.items.codes[it])
                lo, hi = max(offsets[t], starts[w] - n), min(offsets[t + 1], starts[w] + WINDOW + n)
                got = self.checked(it, values[lo:hi].tolist())
                if got and (it not in found[t] or (got[0], c) > (found[t][it][1], found[t][it][0])):
                    found[t][it] = (c, *got)
        return [[(self.items.ids[it], *v) for it, v in sorted(f.items())] for f in found]


def _blocks(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, answer_col: str | None, rank: int, sample: int | None = None):
    """The benchmark in blocks fitted on all texts, one after the other; with
    ``sample`` (to measure what that changes) on about so many, chosen by hash."""
    cols = {"item_id": item_col, "text": "text"} | ({"answer": answer_col} if answer_col else {})
    rows = []
    texts = pick(docs, text=text_col)
    if sample is not None:
        every = max(1, -(-texts.count() // sample))
        texts = texts.where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)      # equal texts are chosen together
    for r in pick(benchmark, **cols).orderBy("item_id", "text").toLocalIterator():
        rows.append((r["item_id"], r["text"], r["answer"] if answer_col else None))
        if len(rows) == BLOCK:
            yield fit_space(texts, items_of(rows), rank)
            rows = []
    if any(words(t or "") for _, t, _ in rows):
        yield fit_space(texts, items_of(rows), rank)


_LEAK = StructType([StructField("item_id", LongType()), StructField("cosine", DoubleType()), StructField("ordered", DoubleType()),
                    StructField("answered", DoubleType())])


def _leaks_udf(docs: DataFrame, items: Items, limits: tuple[float, float, float], run: str, block: int):
    shared = docs.sparkSession.sparkContext.broadcast((items, *limits))

    @F.pandas_udf(ArrayType(_LEAK))
    def leaks(texts: pd.Series) -> pd.Series:
        search = held(f"leaks-{run}", str(block), lambda: Search(*shared.value))
        return pd.Series([[dict(zip(_LEAK.names, x, strict=True)) for x in f] for f in search([t or "" for t in texts])], dtype=object)

    return leaks


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          answer_col: str | None = None, rank: int = RANK, cosine: float = COSINE, ordered: float = ORDERED, answered: float = ANSWERED,
          sample: int | None = None) -> DataFrame:
    """(doc_id, item_id, cosine, ordered, answered): a row for each document and
    benchmark item that leaked into it."""
    own, out, run = pick(docs, doc_id=id_col, text=text_col), None, uuid4().hex
    for block, items in enumerate(_blocks(docs, benchmark, text_col, item_col, answer_col, rank, sample)):
        one = own.select("doc_id", F.explode(_leaks_udf(own, items, (cosine, ordered, answered), run, block)("text")).alias("x")).select("doc_id", "x.*")
        out = one if out is None else out.unionByName(one)
    return out if out is not None else own.limit(0).select("doc_id", F.lit(0).cast("long").alias("item_id"), *[F.lit(0.0).alias(c) for c in _LEAK.names[1:]])


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", answer_col: str | None = None,
               rank: int = RANK) -> DataFrame:
    """``docs`` without those a benchmark item leaked into; all columns are kept."""
    cols = docs.columns
    flat = docs.toDF(*[f"_c{i}" for i in range(len(cols))])
    text, run = f"_c{cols.index(text_col)}", uuid4().hex
    for block, items in enumerate(_blocks(docs, benchmark, text_col, item_col, answer_col, rank)):
        flat = flat.where(F.size(_leaks_udf(flat, items, (COSINE, ORDERED, ANSWERED), run, block)(text)) == 0)
    return flat.toDF(*cols)
