"""Count transducers: weighted acyclic automata over phrases of one to three words.

A phrase is a path from the root; its weight is how often it occurs.  From the
root a word leads to the state of the phrases it begins, a second word to the
state of what may follow the two, a third word to the end; states with equal
weighted continuations are one.  Words are the labels, in byte order, so a
sorted list of n-grams becomes an automaton in one pass over its arrays, and the
phrases of a prefix stand together.

``union`` sums the weights of several automata; ``compose`` runs the phrases of
one through another and gives them the other's weights; ``cut`` deals the phrases out to the
ranges of their prefixes (the first two words, ordered by hash, so that no
frequent first word makes a range larger than others).  All is exact: words are
compared as bytes, weights are 64-bit integers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

_CODEC = pa.Codec("zstd", compression_level=1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _none() -> np.ndarray:
    return np.zeros(0, np.int64)


def no_words() -> pa.Array:
    return pa.array([], pa.large_binary())


@dataclass
class Counts:
    """Weighted phrases by level.  ``words``: the labels, sorted.  ``one``: labels and ``f1`` weights of single words;
    ``two`` (n, 2) and ``f2``: of pairs, sorted; ``parent`` and ``three``: pair and last label of triples, sorted, and ``f3``."""
    words: pa.Array
    one: np.ndarray
    f1: np.ndarray
    two: np.ndarray
    f2: np.ndarray
    parent: np.ndarray
    three: np.ndarray
    f3: np.ndarray

    @property
    def size(self) -> int:
        return len(self.one) + len(self.two) + len(self.three)

    def keys(self) -> np.ndarray:
        """Pairs as sorted numbers."""
        return self.two[:, 0] * (len(self.words) + 1) + self.two[:, 1]


def empty() -> Counts:
    return Counts(no_words(), _none(), _none(), np.zeros((0, 2), np.int64), _none(), _none(), _none(), _none())


def narrow(c: Counts) -> Counts:
    """Without the words that no phrase has."""
    used = np.zeros(len(c.words), bool)
    for x in (c.one, c.two.ravel(), c.three):
        used[x] = True
    if used.all():
        return c
    at = np.cumsum(used) - 1
    return Counts(c.words.filter(pa.array(used)), at[c.one], c.f1, at[c.two], c.f2, c.parent, at[c.three], c.f3)


def from_codes(codes: np.ndarray, words: Sequence[bytes]) -> Counts:
    """All phrases of a sequence of words: ``codes`` are places in ``words``,
    place 0 stands for a boundary that no phrase crosses; a negative place is
    a word that ends phrases but begins none here.  One sort of the word triples,
    shorter at boundaries, gives every level."""
    bits = 21
    if len(words) > 1 << bits:
        raise ValueError(f"more than {1 << bits} words in one piece")
    rank = np.zeros(len(words), np.int64)
    order = np.argsort(np.array(words[1:], object), kind="stable") if len(words) > 1 else _none()
    rank[order + 1] = np.arange(1, len(words))
    labels = pa.array([words[i + 1] for i in order.tolist()], pa.large_binary())
    a = np.concatenate([rank[np.abs(codes)], [0, 0]])
    b = a[1:-1]
    c = np.where(b > 0, a[2:], 0)
    a = a[:-2]
    key = ((a << 2 * bits) | (b << bits) | c)[codes > 0]
    key.sort()
    if not len(key):
        return empty()
    head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    n, key = np.diff(np.append(head, len(key))), key[head]
    first = key >> 2 * bits
    one = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
    pair = key >> bits
    two = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
    f2, labels2 = np.add.reduceat(n, two), pair[two]
    real = (labels2 & ((1 << bits) - 1)) > 0
    of = (np.cumsum(np.append(True, pair[1:] != pair[:-1])) - 1)
    number = np.cumsum(real) - 1
    last = key & ((1 << bits) - 1)
    whole = last > 0
    labels2 = labels2[real]
    return Counts(labels, first[one] - 1, np.add.reduceat(n, one), np.stack([(labels2 >> bits) - 1, (labels2 & ((1 << bits) - 1)) - 1], axis=1), f2[real],
                  number[of[whole]], last[whole] - 1, n[whole])


# ---- union and composition ------------------------------------------------------------------

def _summed(key: np.ndarray, f: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their summed weights, and the place of each row among them."""
    if not len(key):
        return key, f, _none()
    order = np.argsort(key, kind="stable")
    own = key[order]
    fresh = np.append(True, own[1:] != own[:-1])
    head = np.flatnonzero(fresh)
    at = np.empty(len(key), np.int64)
    at[order] = np.cumsum(fresh) - 1
    return own[head], np.add.reduceat(f[order], head), at


def union(parts: Sequence[Counts]) -> Counts:
    """All phrases of the parts, their weights summed."""
    parts = [p for p in parts if p.size]
    if len(parts) < 2:
        return parts[0] if parts else empty()
    coded = pa.concat_arrays([p.words for p in parts]).dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    words = coded.dictionary.take(order)
    rank = np.empty(len(words), np.int64)
    rank[order.to_numpy()] = np.arange(len(words))
    label = rank[coded.indices.to_numpy()]
    shift = np.cumsum([0] + [len(p.words) for p in parts])
    size = len(words) + 1
    one, f1, _ = _summed(np.concatenate([label[p.one + s] for p, s in zip(parts, shift, strict=False)]), np.concatenate([p.f1 for p in parts]))
    pairs = np.concatenate([label[p.two + s] for p, s in zip(parts, shift, strict=False)])
    key, f2, at = _summed(pairs[:, 0] * size + pairs[:, 1], np.concatenate([p.f2 for p in parts]))
    before = np.cumsum([0] + [len(p.two) for p in parts])
    triple = np.concatenate([at[p.parent + b] * size + label[p.three + s] for p, b, s in zip(parts, before, shift, strict=False)])
    key3, f3, _ = _summed(triple, np.concatenate([p.f3 for p in parts]))
    return Counts(words, one, f1, np.stack([key // size, key % size], axis=1), f2, key3 // size, key3 % size, f3)


class Adding:
    """A union that grows part by part; it is summed whenever what has come
    since equals what there was, so each phrase is moved a few times only."""

    def __init__(self, least: int = 1 << 20):
        self.parts, self.new, self.least = [], 0, least

    def add(self, part: Counts) -> None:
        self.parts.append(part)
        self.new += part.size
        if self.new > max(self.least, self.parts[0].size):
            self.parts, self.new = [union(self.parts)], 0

    def total(self) -> Counts:
        self.parts, self.new = [union(self.parts)], 0
        return self.parts[0]


def at_least(c: Counts, least: int) -> Counts:
    """The phrases of at least that weight.  A part of a phrase weighs no less
    than the phrase, so what is left is closed under parts."""
    two, one = c.f2 >= least, c.f1 >= least
    three = (c.f3 >= least) & two[c.parent]
    at = np.cumsum(two) - 1
    return narrow(Counts(c.words, c.one[one], c.f1[one], c.two[two], c.f2[two], at[c.parent[three]], c.three[three], c.f3[three]))


def weights1(c: Counts, words: pa.Array) -> np.ndarray:
    """Weight of each of ``words`` as a phrase (0: not there)."""
    f = np.zeros(len(c.words) + 1, np.int64)
    f[c.one] = c.f1
    return f[labels(c, words)]


def labels(c: Counts, words: pa.Array) -> np.ndarray:
    """Labels of words, ``len(c.words)`` if not there."""
    return pc.fill_null(pc.index_in(words, value_set=c.words), len(c.words)).to_numpy().astype(np.int64)


def places2(c: Counts, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Places of pairs (in labels of ``c``) among the pairs of ``c``, -1 if not there."""
    key, own = first * (len(c.words) + 1) + second, c.keys()
    if not len(own):
        return np.full(len(key), -1)
    at = np.minimum(np.searchsorted(own, key), len(own) - 1)
    return np.where(own[at] == key, at, -1)


def weights2(c: Counts, words: pa.Array, two: np.ndarray) -> np.ndarray:
    """Weights of pairs of labels of ``words`` (0: not there)."""
    own = labels(c, words)
    at = places2(c, own[two[:, 0]], own[two[:, 1]])
    return np.where(at >= 0, c.f2[at], 0) if len(c.f2) else np.zeros(len(two), np.int64)


def compose(asked: Counts, c: Counts) -> Counts:
    """The words and pairs of ``asked`` with their weights in ``c`` (0: not there)."""
    return Counts(asked.words, asked.one, weights1(c, asked.words)[asked.one], asked.two, weights2(c, asked.words, asked.two), _none(), _none(), _none())


# ---- ranges of prefixes ---------------------------------------------------------------------

def _scaled(h: np.ndarray, ranges: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return (((h >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def cut(c: Counts, ranges: int) -> Iterator[tuple[int, Counts]]:
    """(range, its phrases): a pair and the triples it begins are in the range of the pair, a word is in the range of the word."""
    if not c.size:
        return
    h = np.fromiter(map(xxh3_64_intdigest, c.words.to_pylist()), np.uint64, len(c.words))
    in1 = _scaled(h[c.one], ranges)
    in2 = _scaled(h[c.two[:, 0]] * _MIX ^ (h[c.two[:, 1]] + _MIX), ranges)
    by1, by2 = np.argsort(in1, kind="stable"), np.argsort(in2, kind="stable")
    many = np.bincount(c.parent, minlength=len(c.two))
    starts = np.cumsum(many) - many
    own = many[by2]
    by3 = np.repeat(starts[by2] - (np.cumsum(own) - own), own) + np.arange(len(c.three))
    one, f1, two, f2, three, f3 = c.one[by1], c.f1[by1], c.two[by2], c.f2[by2], c.three[by3], c.f3[by3]
    parent, ends = np.repeat(np.arange(len(c.two)), own), np.append(0, np.cumsum(own))
    at1, at2 = (np.searchsorted(x, np.arange(ranges + 1)) for x in (in1[by1], in2[by2]))
    for r in np.flatnonzero((np.diff(at1) > 0) | (np.diff(at2) > 0)).tolist():
        a, b, p, q = at1[r], at1[r + 1], at2[r], at2[r + 1]
        s, t = ends[p], ends[q]
        used, at = np.unique(np.concatenate([one[a:b], two[p:q].ravel(), three[s:t]]), return_inverse=True)
        n, m = b - a, b - a + 2 * (q - p)
        yield r, Counts(c.words.take(pa.array(used)), at[:n], f1[a:b], at[n:m].reshape(-1, 2), f2[p:q], parent[s:t] - p, at[m:], f3[s:t])


# ---- as bytes ---------------------------------------------------------------------------------

def _states(c: Counts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The state each pair leads to (0: none follows), arcs of each state, their labels and weights; equal states are one."""
    many = np.bincount(c.parent, minlength=len(c.two))
    starts = np.cumsum(many) - many
    state = np.zeros(len(c.two), np.int64)
    single = np.flatnonzero(many == 1)
    arc = starts[single]
    top = int(c.f3[arc].max(initial=0)) + 1
    if top < (1 << 62) // (len(c.words) + 1):
        key = c.three[arc] * top + c.f3[arc]
        _, rows, at = np.unique(key, return_index=True, return_inverse=True)
    else:
        rows, at = np.arange(len(arc)), np.arange(len(arc))
    state[single] = at + 1
    sizes, arcs = [1] * len(rows), [arc[rows]]
    seen: dict[bytes, int] = {}
    for i in np.flatnonzero(many > 1).tolist():
        s, t = starts[i], starts[i] + many[i]
        sign = c.three[s:t].tobytes() + c.f3[s:t].tobytes()
        if sign not in seen:
            seen[sign] = len(rows) + len(seen) + 1
            sizes.append(int(many[i]))
            arcs.append(np.arange(s, t))
        state[i] = seen[sign]
    flat = np.concatenate(arcs)
    return state, np.array(sizes, np.int64), c.three[flat], c.f3[flat]


def to_bytes(c: Counts) -> bytes:
    state, sizes, last, f3 = _states(c)
    lengths = pc.binary_length(c.words).to_numpy().astype(np.int64)
    gap = np.diff(c.two[:, 0], prepend=0)
    arrays = [lengths, c.one, c.f1, gap, c.two[:, 1], c.f2, state, sizes, last, f3]
    head, body = [], []
    for x in arrays:
        wide = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
        head += [len(x), wide]
        body.append(np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :wide].T).tobytes())      # like bytes together
    plain = np.array(head, "<i8").tobytes() + b"".join(body) + b"".join(c.words.to_pylist())
    return len(plain).to_bytes(8, "little") + _CODEC.compress(plain, asbytes=True)


def from_bytes(data: bytes) -> Counts:
    plain = _CODEC.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), asbytes=True)
    head = np.frombuffer(plain, "<i8", 20).reshape(-1, 2).tolist()
    at, arrays = 160, []
    for n, wide in head:
        full = np.zeros((n, 8), np.uint8)
        full[:, :wide] = np.frombuffer(plain, np.uint8, n * wide, at).reshape(wide, n).T
        arrays.append(full.reshape(-1).view("<i8").astype(np.int64))
        at += n * wide
    lengths, one, f1, gap, second, f2, state, sizes, last, f3 = arrays
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(plain[at:])])
    many = np.append(0, sizes)[state]
    starts = (np.cumsum(np.append(0, sizes)) - np.append(0, sizes))[state]
    arc = np.repeat(starts - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
    return Counts(words, one, f1, np.stack([np.cumsum(gap), second], axis=1), f2, np.repeat(np.arange(len(state)), many), last[arc], f3[arc])
