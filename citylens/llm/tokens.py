"""Token ids of whole texts by a public byte-level BPE, a batch at a time.

The pre-tokenizer of the vocabulary (letters, digits, other signs, white space,
each run with at most one leading space) always starts a new piece at a space
or line feed that stands alone between other signs.  A text without two white
space signs in a row can therefore be cut there, and the ids of a piece depend
on the piece only.  A batch of texts is split and coded by Arrow; only pieces
not seen before are encoded, and kept in a bounded table per worker.  Texts
with other white space are encoded in one go, and texts with added tokens of the
vocabulary (``added_tokens``) are cut at them: each has its own id, and what
lies between is encoded as a text of its own.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import held

_WHOLE = re.compile(r"\s\s|[^\S \n]")
#: signs of text coded at once (bounds the memory of a worker)
CHARS = 4_000_000

#: signs of text cut into pieces at once by an encoder (its arrays are many times the text)
SPLIT = 1_000_000


def by_size(texts: Sequence[str], limit: int = CHARS) -> Iterator[tuple[int, int]]:
    """Runs [from, to) of texts of at most ``limit`` signs together, or of one text."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        if i > start and total + len(t) > limit:
            yield start, i
            start, total = i, 0
        total += len(t)
    if start < len(texts):
        yield start, len(texts)


def gather(flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs flat[starts[i] : starts[i] + counts[i]] one after the other."""
    total = int(counts.sum())
    out = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    out += np.arange(total)
    return flat[out]


class Pieces:
    """Numbers distinct strings and holds a run of values for each; emptied
    when it exceeds ``limit`` strings (between batches only)."""

    def __init__(self, encode, dtype, limit: int = 250_000):
        self.encode, self.dtype, self.limit = encode, dtype, limit
        self.known: dict[str, int] = {}
        self.flat = np.zeros(1 << 16, dtype)
        self.ends = np.zeros(1 << 12, np.int64)      # end of each string's run in flat

    def numbers(self, strings: list[str]) -> np.ndarray:
        """The numbers of distinct strings."""
        if len(self.known) > self.limit:
            self.known = {}
        known = self.known
        out = np.fromiter(map(known.get, strings, repeat(-1)), np.int64, len(strings))
        unknown = np.flatnonzero(out < 0)
        if len(unknown):
            new = [strings[i] for i in unknown]
            n = len(known)
            values, counts = self.encode(new)
            base = int(self.ends[n - 1]) if n else 0
            ends = base + np.cumsum(counts)
            while n + len(new) > len(self.ends):
                self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
            while base + len(values) > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.ends[n: n + len(new)] = ends
            self.flat[base: base + len(values)] = values
            known.update(zip(new, range(n, n + len(new)), strict=True))
            out[unknown] = np.arange(n, n + len(new))
        return out

    def runs(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start in flat, count) of the given strings."""
        starts = np.where(numbers > 0, self.ends[numbers - 1], 0)
        return starts, self.ends[numbers] - starts


def coded(lists: pa.ListArray, table: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets): the values of all strings of each list, in order."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten().dictionary_encode()
    numbers = table.numbers(words.dictionary.to_numpy(zero_copy_only=False).tolist())
    starts, counts = table.runs(numbers)
    codes = words.indices.to_numpy()
    per = counts[codes]
    ends = np.concatenate([[0], np.cumsum(per)])
    return gather(table.flat, starts[codes], per), ends[offsets - offsets[0]]



def _byte_of_sign() -> dict[str, int]:
    """The printable sign that a byte-level vocabulary file writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _default() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def added_tokens(path: str | None = None) -> dict[str, int]:
    """string -> id of the tokens that a JSON file of ``tokenizers`` adds to its
    model: wherever a text holds one it has that id.  A ``.tiktoken`` file has none."""
    path = path or _default()
    if path.endswith(".tiktoken"):
        return {}
    with open(path, encoding="utf-8") as f:
        added = json.load(f).get("added_tokens", [])
    if odd := [t["content"] for t in added if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]:
        raise ValueError(f"{path}: added tokens that depend on the signs around them: {odd}")
    return {t["content"]: t["id"] for t in added}


def vocabulary(path: str | None = None) -> dict[bytes, int]:
    """bytes -> id of a byte-level BPE whose ids are in merge order: a JSON file
    of ``tokenizers`` or a ``.tiktoken`` file (default: the public one of 50k,
    JSON form).  Special tokens are left out (see ``added_tokens``)."""
    path = path or _default()
    with open(path, encoding="utf-8") as f:
        if path.endswith(".tiktoken"):
            return {base64.b64decode(t): int(i) for t, i in map(str.split, f)}
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path} is no byte-level BPE")
    signs, special = _byte_of_sign(), {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(map(signs.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if t not in special}


class Encoder:
    """Ids by a byte-level BPE given as bytes -> id; ``added`` tokens, given as
    string -> id, are ordinary text unless given."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 1_000_000, added: dict[str, int] | None = None):
        import tiktoken

        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"      # fixed value: the pre-tokenizer's
        self.bpe = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.feed = ranks[b"\n"]
        self.leads = np.zeros(max(ranks.values()) + 1, bool)
        self.leads[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        self.table = Pieces(self._new, np.uint32, limit)
        self.added = added or {}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None

    def _new(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces: a piece has no space; its run begins with the one that
        leads it in a text, or with a line feed.  All are encoded as one text
        and told apart by the ids that begin with a space, or are a line feed."""
        spaced = np.fromiter((not p.startswith("\n") for p in pieces), bool, len(pieces))
        parts = []
        for kind, text in ((True, "".join(" " + p for p in pieces if not p.startswith("\n"))),
                           (False, "".join(p for p in pieces if p.startswith("\n")))):
            ids = np.array(self.bpe.encode_ordinary(text), np.uint32)
            parts.append((ids, np.flatnonzero(self.leads[ids] if kind else ids == self.feed)))
        counts = np.zeros(len(pieces), np.int64)
        starts = np.zeros(len(pieces), np.int64)
        base = 0
        for mask, (ids, at) in ((spaced, parts[0]), (~spaced, parts[1])):
            counts[mask] = np.diff(np.append(at, len(ids)))
            starts[mask] = at + base
            base += len(ids)
        return gather(np.concatenate([p[0] for p in parts]), starts, counts), counts

    def whole(self, text: str) -> np.ndarray:
        if not self.cut:
            return np.array(self.bpe.encode_ordinary(text), np.uint32)
        ids: list[int] = []
        for i, part in enumerate(self.cut.split(text)):              # the odd ones are added tokens
            ids += [self.added[part]] if i % 2 else self.bpe.encode_ordinary(part)
        return np.array(ids, np.uint32)

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        for a, b in by_size(texts, SPLIT):
            odd = [not t or _WHOLE.search(t) is not None or t[-1] in " \n" or bool(self.cut and self.cut.search(t)) for t in texts[a:b]]
            lines = pa.array(["" if o else "\n" + t for o, t in zip(odd, texts[a:b], strict=True)], pa.large_string())
            split = pc.split_pattern(pc.replace_substring(lines, "\n", " \n"), " ")
            values, at = coded(_without_first(split), self.table)
            for i, o in enumerate(odd):
                yield self.whole(texts[a + i]) if o else values[at[i] + 1: at[i + 1]]      # less the line feed put before


def _without_first(lists) -> pa.ListArray:
    """Lists of strings without their (empty) first string."""
    off = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    keep = np.ones(len(flat), bool)
    keep[off[:-1] - off[0]] = False
    counts = np.diff(off) - 1
    return pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), flat.filter(pa.array(keep)))


#: pieces that the encoders of a worker hold together
PIECES = 400_000


def encoder(name: str, ranks, among: int = 1, added: dict[str, int] | None = None) -> Encoder:
    """One encoder per worker process and name, one ``among`` several in use;
    ``ranks`` is a broadcast vocabulary."""
    return held("ids", name if not added else f"{name} {sorted(added.items())}", lambda: Encoder(ranks.value, PIECES // among, added))
