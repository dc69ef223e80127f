"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label.  Every passage (some
``PASSAGE`` bytes, cut at white space) is encoded as ``h = tanh(x W + b)`` from
what can be counted in it: kinds of signs and of pairs of neighbouring signs,
words by hash, and how often words repeat.  Gated attention
``a = softmax(w . (tanh(h V) * sigmoid(h U)))`` weighs the passages of a
document, and the weighted representation ``z = sum a h`` is scored,
``sigmoid(c . z + c0)``.  ``W, b, V, U, w, c, c0`` are learned together from the
labels of documents, so a few bad passages of a long text can decide its score.

The model is fitted in one task on at most ``SAMPLE`` labelled documents, those of least id
hash, and no further than ``BAGS`` passages (whole documents); this is the one
bounded part.  Scoring reads every whole text where it lies: nothing is shuffled
and memory is that of ``_BLOCK`` bytes of text and the encoded passages of one document.

Defined results: a null text is empty; an empty text is one passage without
signs and is scored like any other; repeated rows and null ids are scored each;
of several labels of an id the lowest counts, of several texts of a labelled id
the least one is learned from; labels without a document, an id or a value count
nothing; where all labels are equal that value is every score, where there are
none it is 0.5; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, held, keep, pick, release
from .tokens import by_size

#: labelled documents, and their passages, that the model is fitted on, at most
SAMPLE = 6_000
BAGS = 40_000
#: bytes of a passage, and how many more may follow up to the next white space
PASSAGE = 512
_OVER = 128
#: score from which a document counts as good
GOOD_FROM = 0.3
#: width of a passage's representation and of its gates
HIDDEN = 32
GATE = 16
EPOCHS = 12
BATCH = 64
STEP = 3e-3
RIDGE = 1e-4
_BLOCK = 1 << 19

# ---- what is counted in a passage ---------------------------------------------------------

_BYTE = np.arange(256)
_SPACE = (_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13))
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LOWER = (_BYTE >= 97) & (_BYTE <= 122)
_DIGIT = (_BYTE >= 48) & (_BYTE <= 57)
_HIGH = _BYTE >= 128
_FOLD = np.where(_UPPER, _BYTE + 32, _BYTE).astype(np.uint64)
_FOLD[~(_UPPER | _LOWER | _DIGIT | _HIGH)] = 0                # words are told apart by letters and digits


def _kinds(*groups) -> np.ndarray:
    """Number of the first group that holds a byte."""
    out = np.full(256, len(groups), np.int64)
    for i, g in reversed(list(enumerate(groups))):
        out[g if isinstance(g, np.ndarray) else np.isin(_BYTE, np.frombuffer(g, np.uint8))] = i
    return out


_PLAIN = [_LOWER, _UPPER, _DIGIT, _HIGH, b" ", b"\n", _SPACE]
_SIGN = _kinds(*_PLAIN, *[bytes([x]) for x in range(33, 127) if not chr(x).isalnum()])       # every punctuation sign by itself; last: controls
_COARSE = _kinds(*_PLAIN, b".,;:!?", b"'\"`", b"()[]{}<>", b"-_/\\|", b"#$%&*+=@^~")
_SIGNS, _PAIRS = int(_SIGN.max()) + 1, int(_COARSE.max()) + 1
_WORDS = 512
_NUMBERS = 6
#: numbers that describe a passage
WIDTH = _SIGNS + _PAIRS * _PAIRS + _WORDS + _NUMBERS
_POWER = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def cut(text: np.ndarray) -> np.ndarray:
    """Ends of the passages of a text (bytes); an empty text has one."""
    n = len(text)
    if n <= PASSAGE + _OVER:
        return np.array([n])
    goal = np.arange(PASSAGE, n - _OVER, PASSAGE)
    space = np.flatnonzero(_SPACE[text])
    after = np.append(space, n)[np.searchsorted(space, goal)]
    return np.append(np.where(after - goal <= _OVER, after, goal), n)


def describe(text: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(passages, WIDTH): the counted features of passages of ``sizes`` bytes, one after the other."""
    n, p = len(text), len(sizes)
    out = np.zeros((p, WIDTH), np.float32)
    if not n:
        return out
    of = np.repeat(np.arange(p), sizes)
    length = np.maximum(sizes, 1)[:, None]
    out[:, :_SIGNS] = np.sqrt(np.bincount(of * _SIGNS + _SIGN[text], minlength=p * _SIGNS).reshape(p, _SIGNS) / length)
    kind, inside = _COARSE[text], of[1:] == of[:-1]
    pair = (of[1:] * _PAIRS + kind[:-1]) * _PAIRS + kind[1:]
    width = _PAIRS * _PAIRS
    out[:, _SIGNS: _SIGNS + width] = np.sqrt(np.bincount(pair[inside], minlength=p * width).reshape(p, width) / length)
    blank = _SPACE[text]
    fresh = ~blank
    fresh[1:] &= blank[:-1] | ~inside
    first = np.flatnonzero(fresh)
    out[:, -_NUMBERS] = np.log1p(sizes)
    if not len(first):
        return out
    back = np.zeros(n, np.int64)                        # place in the word
    back[first[0]:] = np.arange(first[0], n) - np.repeat(first, np.diff(np.append(first, n)))
    value = _FOLD[text]
    value[blank] = 0
    word = np.add.reduceat(value * _POWER[back & 63], first) * _MIX
    word ^= word >> np.uint64(29)
    own = of[first]
    many = np.bincount(own, minlength=p)
    words = np.maximum(many, 1)
    at = _SIGNS + width
    bucket = ((word * _MIX) >> np.uint64(55)).astype(np.int64)
    out[:, at: at + _WORDS] = np.sqrt(np.bincount(own * _WORDS + bucket, minlength=p * _WORDS).reshape(p, _WORDS) / words[:, None])
    key = np.sort((own.astype(np.uint64) << np.uint64(40)) | (word >> np.uint64(24)))
    heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    of_head = (key[heads] >> np.uint64(40)).astype(np.int64)
    most = np.zeros(p, np.int64)
    np.maximum.at(most, of_head, np.diff(np.append(heads, len(key))))
    again = np.bincount(own[1:][(word[1:] == word[:-1]) & (own[1:] == own[:-1])], minlength=p)
    at += _WORDS + 1
    for k, x in enumerate((np.log1p(many), many * 6 / length[:, 0], np.bincount(of_head, minlength=p) / words, most / words, again / words)):
        out[:, at + k] = x
    return out


# ---- the model ------------------------------------------------------------------------------

@dataclass
class Model:
    """Weights; ``only``: the score of everything, where nothing could be learned."""
    only: float | None = None
    weights: dict[str, np.ndarray] | None = None

    def encode(self, x: np.ndarray) -> np.ndarray:
        w = self.weights
        return np.tanh(np.clip((x - w["mean"]) * w["scale"], -5, 5) @ w["W"] + w["b"])

    def energy(self, h: np.ndarray) -> np.ndarray:
        w = self.weights
        return (np.tanh(h @ w["V"]) * _sigmoid(h @ w["U"])) @ w["w"]

    def scores(self, h: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Scores of documents whose passages (``bags`` of them each) are encoded in ``h``."""
        a = attention(self.energy(h), bags)
        z = np.add.reduceat(a[:, None] * h, np.cumsum(bags) - bags)
        return _sigmoid((z @ self.weights["c"] + self.weights["c0"]).astype(np.float64))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def attention(energy: np.ndarray, bags: np.ndarray) -> np.ndarray:
    """Softmax within each bag (no bag is empty)."""
    starts = np.cumsum(bags) - bags
    e = np.exp(energy - np.repeat(np.maximum.reduceat(energy, starts), bags))
    return e / np.repeat(np.add.reduceat(e, starts), bags)


def fit(x: np.ndarray, bags: np.ndarray, label: np.ndarray, epochs: int = EPOCHS, seed: int = 17) -> Model:
    """Learns all weights together from ``label`` (0/1) of bags of described passages, by Adam."""
    if not len(label):
        return Model(only=0.5)
    if label.min() == label.max():
        return Model(only=float(label[0]))
    rng = np.random.default_rng(seed)
    mean = x.mean(axis=0, dtype=np.float64).astype(np.float32)
    scale = (1 / np.maximum(x.std(axis=0, dtype=np.float64), 0.02)).astype(np.float32)
    share = float(label.mean())
    w = {"W": rng.normal(0, 0.3 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), "b": np.zeros(HIDDEN),
         "V": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)), "U": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATE)),
         "w": rng.normal(0, GATE ** -0.5, GATE), "c": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "c0": np.array([np.log(share / (1 - share))])}
    w = {k: v.astype(np.float32) for k, v in w.items()}
    first, second = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    model = Model(weights=w | {"mean": mean, "scale": scale})
    ends = np.cumsum(bags)
    step, last = 0, epochs * -(-len(label) // BATCH)
    for _ in range(epochs):
        mixed = rng.permutation(len(label))
        for at in range(0, len(mixed), BATCH):
            some = mixed[at: at + BATCH]
            own, size = np.concatenate([np.arange(ends[i] - bags[i], ends[i]) for i in some]), bags[some]
            starts = np.cumsum(size) - size
            xs = np.clip((x[own] - mean) * scale, -5, 5)
            h = np.tanh(xs @ w["W"] + w["b"])
            t, s = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
            a = attention((t * s) @ w["w"], size)
            z = np.add.reduceat(a[:, None] * h, starts)
            miss = ((_sigmoid(z @ w["c"] + w["c0"]) - label[some]) / len(some)).astype(np.float32)
            g = {"c": z.T @ miss, "c0": miss.sum(keepdims=True)}
            dz = np.repeat(miss[:, None] * w["c"], size, axis=0)
            da = (dz * h).sum(axis=1)
            de = a * (da - np.repeat(np.add.reduceat(a * da, starts), size))
            g["w"] = (t * s).T @ de
            dt, ds = de[:, None] * w["w"] * s * (1 - t * t), de[:, None] * w["w"] * t * s * (1 - s)
            g["V"], g["U"] = h.T @ dt, h.T @ ds
            dh = (a[:, None] * dz + dt @ w["V"].T + ds @ w["U"].T) * (1 - h * h)
            g["W"], g["b"] = xs.T @ dh, dh.sum(axis=0)
            step += 1
            rate = STEP * (1 - 0.9 * step / last)
            for k in w:
                grad = g[k] + RIDGE * w[k] * (k not in ("b", "c0"))
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad * grad - second[k])
                w[k] -= (rate * first[k] / (1 - 0.9 ** step) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return model


def packed(model: Model) -> bytes:
    out = io.BytesIO()
    np.savez(out, **({"only": np.array(model.only)} if model.weights is None else model.weights))
    return out.getvalue()


def unpacked(data: bytes) -> Model:
    got = dict(np.load(io.BytesIO(data)))
    return Model(only=float(got["only"])) if "only" in got else Model(weights=got)


# ---- Spark jobs -------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(doc_id, label, text) of at most ``sample`` labelled ids that have a document, by least id hash."""
    own = pick(docs, doc_id=id_col, text=text_col)
    low = pick(labels, l_id="doc_id", label=label_col).where("l_id is not null and label is not null").groupBy("l_id").agg(F.min("label").alias("label"))
    chosen = low.orderBy(F.xxhash64("l_id"), "l_id").limit(sample)
    return own.join(F.broadcast(chosen), F.col("doc_id") == F.col("l_id")).groupBy("doc_id").agg(
        F.min("label").cast("int").alias("label"), F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bags: int = BAGS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fits the model on ``labels`` (doc_id, 0/1).  The one fitting task gets at
    most ``sample`` texts and describes them until ``bags`` passages are reached."""
    rows = keep(labelled_sample(docs, labels, sample, id_col, text_col, label_col), "quality-sample")

    def learn(batches):
        xs, sizes, y, total = [np.zeros((0, WIDTH), np.float32)], [], [], 0
        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist(), strict=True):
                data = np.frombuffer(text or b"", np.uint8)
                ends = cut(data)
                if total + len(ends) > bags and total:
                    continue
                total += len(ends)
                xs.append(describe(data, np.diff(ends, prepend=0)))
                sizes.append(len(ends))
                y.append(label)
        model = fit(np.concatenate(xs), np.array(sizes, np.int64), np.array(y, np.float32))
        yield pa.RecordBatch.from_arrays([pa.array([packed(model)], pa.binary())], names=["model"])

    one = rows.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id").select("label", "text")
    got = one.mapInArrow(learn, "model binary").collect()       # one row
    return unpacked(got[0]["model"]) if got else Model(only=0.5)


def scores_of(model: Model, texts: list[bytes]) -> np.ndarray:
    """Scores of whole texts; the passages of a long one are encoded block by block."""
    if model.weights is None:
        return np.full(len(texts), model.only)
    h, bags = [], []
    for a, b in by_size(texts, _BLOCK):
        data = np.frombuffer(b"".join(texts[a:b]), np.uint8)
        size, at = [], 0
        for t in texts[a:b]:
            ends = cut(data[at: at + len(t)])
            bags.append(len(ends))
            size.append(np.diff(ends, prepend=0))
            at += len(t)
        size = np.concatenate(size)
        ends = np.cumsum(size)
        start = 0
        while start < len(size):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start] - size[start]) + _BLOCK + 1)))
            h.append(model.encode(describe(data[ends[start] - size[start]: ends[stop - 1]], size[start:stop])))
            start = stop
    return model.scores(np.concatenate(h), np.array(bags)) if h else np.zeros(0)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every document, 0 to 1."""
    from uuid import uuid4

    shared, name = docs.sparkSession.sparkContext.broadcast(packed(model)), uuid4().hex

    def run(batch):
        own = held(f"quality-{name}", "", lambda: unpacked(shared.value))
        return {"doc_id": batch.column(0), "score": scores_of(own, [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()])}

    own = pick(docs, doc_id=id_col, text=text_col)
    return arrow_map(own.select("doc_id", "text"), run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, score double")


def held_out(doc_id):
    """Whether a row is kept from training: crc32 of the id as text, divisible by 5 (null: not)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted): learned from the labelled rows that are not held out, over every document."""
    own = pick(labels, doc_id="doc_id", quality="quality")
    model = train(docs, own.where(~held_out(F.col("doc_id"))), sample)
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
