"""Periodic runs of words, by maximal pairs.

A run is a stretch of consecutive words with smallest period ``q`` and at least
``max(least, power * q)`` words that no neighbouring word extends keeping the
period.  Two suffixes that start ``q`` words apart and share ``l`` words, and no
more on either side (a *maximal pair*), are such a stretch of ``l + q`` words;
so the pairs with ``l >= (power - 1) * q`` are exactly the runs, and nothing is
extended afterwards.

The pairs come from the tree of LCP intervals of a document, bottom-up.  Every
interval holds its positions with the class of their left word, in order of
position; where intervals meet, the smaller list goes into the larger one, and
a position is paired with its neighbours of another class.  Only neighbours can
be a run's pair: an occurrence between the two would give the stretch a smaller
period.  Each position is moved at most log(n) times.

The suffixes of many documents are sorted at once by prefix doubling; a word
sequence is told apart by its document, and only suffixes that still share
their prefix with another one are sorted again.

Documents never meet: a task works through its rows in pieces of ``_PIECE``
bytes (a longer text is one piece) and nothing is shuffled.  Memory of a piece
is a few arrays of its words for each doubling of its longest repeat.

Defined results: words are what stands between white space (``\\x20``,
``\\x09-\\x0D``); a null text is empty and has no words and no runs; repeated
rows and null ids give a row each; an empty table gives an empty one; further
columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, release
from .tokens import by_size

#: a run has at least this many words, and at least this many times its period
LEAST = 6
POWER = 4
#: bytes of text whose suffixes are sorted together
_PIECE = 1 << 21

_SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


class Suffixes:
    """Suffixes of several word sequences (``codes``, one after the other) as
    far as they share words with another suffix of the same sequence.

    ``order``: positions in suffix order; ``shared``: words that each shares
    with the one before it in ``order`` (0 below 4, where none is needed).
    """

    def __init__(self, codes: np.ndarray, sizes: np.ndarray):
        n, docs = len(codes), len(sizes)
        size = int(codes.max(initial=-1)) + 2
        # one end sign after each sequence, so that no suffix runs into the next one
        ends = np.cumsum(sizes) + np.arange(docs)
        words = np.full(n + docs, size - 1, np.int64)
        body = np.ones(n + docs, bool)
        body[ends] = False
        words[body] = codes
        self.words, self.doc = words, np.repeat(np.arange(docs), sizes + 1)
        self.starts = ends - sizes
        after = np.append(words[1:], size - 1)
        if docs * size < (1 << 62) // size:
            key = (self.doc * size + words) * size + after
        else:
            key = np.unique(self.doc * size + words, return_inverse=True)[1] * size + after
        key[ends] = -1 - np.arange(docs)
        self.levels = []                        # [k]: rank by the first 2 ** (k + 1) words
        order = np.argsort(key, kind="stable")
        own = key[order]
        rank = np.zeros(n + docs, np.int64)
        rank[order] = _first_of_equal(own[1:] != own[:-1])
        self.levels.append(rank.astype(np.int32 if n + docs < 1 << 31 else np.int64))
        left = _in_groups(own)
        places = np.flatnonzero(left)           # places in the order that are not settled
        width = 2
        while len(places):
            at = order[places]
            first = rank[at]
            key = first * (n + docs + 1) + rank[at + width]
            by = np.argsort(key, kind="stable")
            own = key[by]
            order[places] = at[by]
            rank = rank.copy()
            fresh = np.ones(len(own), bool)
            fresh[1:] = own[1:] != own[:-1]
            rank[at[by]] = places[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
            self.levels.append(rank.astype(self.levels[0].dtype))
            places = places[_in_groups(own)]
            width *= 2
        self.order = order
        self.shared = self._shared()

    def _shared(self) -> np.ndarray:
        out = np.zeros(len(self.order), np.int64)
        if len(self.levels) < 2:
            return out
        four = self.levels[1][self.order]
        at = np.flatnonzero(four[1:] == four[:-1]) + 1
        i, j = self.order[at - 1].copy(), self.order[at].copy()
        got = np.zeros(len(at), np.int64)
        for k in range(len(self.levels) - 1, -1, -1):
            same = self.levels[k][i] == self.levels[k][j]
            step = same * (2 << k)
            i += step
            j += step
            got += step
        got += self.words[i] == self.words[j]       # two end signs of a document never meet: they are one position
        out[at] = got
        return out


def _first_of_equal(differs: np.ndarray) -> np.ndarray:
    """For sorted keys: index of the first of the equal ones."""
    fresh = np.concatenate([[True], differs])
    return np.flatnonzero(fresh)[np.cumsum(fresh) - 1]


def _in_groups(own: np.ndarray) -> np.ndarray:
    """Whether a sorted key stands beside an equal one."""
    same = own[1:] == own[:-1]
    out = np.zeros(len(own), bool)
    out[1:] |= same
    out[:-1] |= same
    return out


def _pairs(order: list[int], shared: list[int], left: list[int], least: int, power: int) -> list[tuple[int, int, int]]:
    """Maximal pairs (i, j, words shared) of one block of suffixes that satisfy
    the length constraints, by a bottom-up pass over its LCP intervals.

    ``shared[t]`` belongs to ``order[t - 1]`` and ``order[t]``; ``left[t]`` is the class of
    the word before ``order[t]``.
    """
    out = []
    cls = dict(zip(order, left, strict=True))

    def join(big: list[int], small: list[int], l: int) -> list[int]:
        if len(big) < len(small):
            big, small = small, big
        reach = l // (power - 1)
        for x in small:
            at = bisect_left(big, x)
            if at and x - big[at - 1] <= reach and l + x - big[at - 1] >= least and cls[big[at - 1]] != cls[x]:
                out.append((big[at - 1], x, l))
            if at < len(big) and big[at] - x <= reach and l + big[at] - x >= least and cls[big[at]] != cls[x]:
                out.append((x, big[at], l))
        if len(small) * 8 > len(big):
            big += small
            big.sort()                                  # two sorted stretches: merged
        else:
            for x in small:
                big.insert(bisect_left(big, x), x)
        return big

    open_at, lists = [], []                             # the open intervals: words shared, positions
    last = [order[0]]
    for t in range(1, len(order) + 1):
        l = shared[t] if t < len(order) else 0
        while open_at and open_at[-1] > l:
            value, own = open_at.pop(), lists.pop()
            last = join(own, last, value)
        if t == len(order):
            break
        if open_at and open_at[-1] == l:
            lists[-1] = join(lists[-1], last, l)
        else:
            open_at.append(l)
            lists.append(last)
        last = [order[t]]
    return out


def runs(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST, power: int = POWER) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each word sequence, by start, then
    period.  ``codes``: the sequences' words as numbers, one sequence after the
    other; ``sizes``: how many words each has."""
    if power < 3 or least < power + 1:
        raise ValueError("runs are searched among suffixes that share at least four words")
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    s = Suffixes(codes, sizes)
    bottom = min(q * (power - 1) if q * power >= least else least - q for q in range(1, least + 1))
    linked = s.shared >= max(bottom, 4)
    # blocks of the order whose neighbours share enough words
    inside = linked.copy()
    inside[:-1] |= linked[1:]
    at = np.flatnonzero(inside)
    if not len(at):
        return found
    block = np.cumsum(~linked[at])                      # a block's first has too little in common with what stands before
    position, shared = s.order[at], np.where(linked[at], s.shared[at], 0)
    # a block without two positions near enough for its longest shared prefix has no pair
    by = np.lexsort((position, block))
    gap = np.diff(position[by])
    gap[np.diff(block[by]) > 0] = np.iinfo(np.int64).max
    heads = np.flatnonzero(np.append(True, np.diff(block) > 0))
    nearest = np.minimum.reduceat(np.append(gap, np.iinfo(np.int64).max), heads)
    longest = np.maximum.reduceat(shared, heads)
    good = nearest <= longest // (power - 1)
    tails = np.append(heads[1:], len(at))
    for a, b in zip(heads[good].tolist(), tails[good].tolist(), strict=True):
        pos = position[a:b]
        d = int(s.doc[pos[0]])
        first = int(s.starts[d])
        left = np.where(pos > first, s.words[pos - 1], -1)
        for i, j, l in _pairs(pos.tolist(), shared[a:b].tolist(), left.tolist(), least, power):
            found[d].append((i - first, l + j - i, j - i))
    out = []
    for own in found:
        best: dict[tuple[int, int], int] = {}
        for start, length, q in own:                    # a multiple of the period gives the same stretch
            best[start, length] = min(q, best.get((start, length), q))
        out.append(sorted(((a, n, q) for (a, n), q in best.items()), key=lambda r: (r[0], r[2])))
    return out


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without what follows the first period of a run."""
    if not found:
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, q in found:
        change[start + q] += 1
        change[start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(kept).tolist()])


def periodic_runs(docs: DataFrame, least: int = LEAST, power: int = POWER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every document: its runs by start,
    then period, and its text without the repeats (words joined by one space,
    each run cut to its first period)."""
    def piece(texts: list[bytes]):
        split = [t.split() for t in texts]              # bytes: at \x20 and \x09-\x0D
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        number: dict[bytes, int] = {}
        codes = np.fromiter((number.setdefault(w, len(number)) for words in split for w in words), np.int64, int(sizes.sum()))
        found = runs(codes, sizes, least, power)
        return sizes, found, [collapse(w, f) for w, f in zip(split, found, strict=True)]

    def rows(batches):
        release()
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for at, end in by_size(texts, _PIECE):
                sizes, found, collapsed = piece(texts[at:end])
                flat = [r for f in found for r in f]
                offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
                spans = pa.StructArray.from_arrays([pa.array([r[k] for r in flat], pa.int64()) for k in range(3)], names=["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, end - at), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans),
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    own = pick(docs, doc_id=id_col, text=text_col)
    return own.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, _SCHEMA)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) as the contract of op11 edits it: where h = crc32(id) is
    divisible by 10, each word i >= a becomes word a + (i - a) % p of the same
    text, with g = h / 10, a = g % n, p = 1 + (n - a) / (3 + g % 8).  Rows
    without id keep their text."""
    own = pick(docs, doc_id=id_col, text=text_col)
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = own.withColumn("h", h).withColumn(
        "w", F.when(F.col("h") % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != "")))
    sizes = words.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    placed = sizes.withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int"))).withColumn(
        "p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    edited = F.array_join(F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(
        F.get("w", F.col("a") + F.pmod(i - F.col("a"), F.col("p"))))), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """The columns of op11's contract, from the rows of ``periodic_runs``."""
    # longest first, then least start, then least period
    top = F.try_element_at(F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period")))), F.lit(1))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    t = found.withColumn("top", top)
    return t.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("top.start").alias("start"), (-F.col("top.less")).alias("length"),
        F.col("top.period").alias("period"), F.expr("(1000 * -top.less) div top.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
