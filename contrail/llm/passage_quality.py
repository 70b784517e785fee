"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each, the last one shorter); only
the document carries a label.

1. Every passage of the whole text is encoded: how often each pair of neighbouring
   character kinds occurs (square roots of shares), the share of its words in
   five-word windows that occur twice or more in the document, its mean word
   length, and the sizes of passage and document.
2. A small network maps each encoding to ``HIDDEN`` numbers e; gated attention,
   softmax over the passages of w . (tanh(V e) * sigmoid(U e)), says how much each
   passage counts; the document's representation is the weighted sum of its e, and
   a logistic function of it is the score.  All weights are learned together from the
   document labels (Adam on the log loss, fixed seed and order).

Training uses at most ``SAMPLE`` labelled documents that the caller lets it see, those
whose hashed ids come first, so the classes keep their mix and the cut at 0.5 means the
same at every size; of each at most ``TRAIN_PASSAGES`` evenly spaced passages.  So what
reaches the driver is bounded.  Scoring encodes all passages of all texts, row by row,
without a shuffle; a long text is encoded in blocks of passages.

Defined cases: a null, empty or blank text is one passage without words; very long
texts are read whole; repeated rows get equal scores; a doc_id labelled twice
has the higher label (ties in the order of the sample go by the id);
without labels of both classes every score is the share of label 1 (0.5 if there
are none); an empty table gives an empty result; other columns, whatever their names,
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_batches

PASSAGE = 64
WINDOW = 5
SAMPLE = 3000
TRAIN_PASSAGES = 16
HIDDEN = 24
GATES = 16
EPOCHS = 30
BATCH = 64
RATE = 0.005
DECAY = 1e-4
THRESHOLD = 0.5
#: Passages whose bytes are counted at once.
BLOCK = 4096

#: Kinds of bytes; what isn't named here is of kind 0 (control) or 1 (other sign).
_GROUPS = [b" ", b"\t\v\f\r", b"\n", bytes(range(97, 123)), bytes(range(65, 91)), b"0123456789", bytes(range(128, 256)), b".", b",", b"!?", b"#*$%&@^~=",
           b"|<>", b"'\"()-:;"]
KINDS = len(_GROUPS) + 2
_KIND = np.ones(256, dtype=np.int64)
_KIND[:32] = 0
for _n, _bytes in enumerate(_GROUPS, 2):
    _KIND[list(_bytes)] = _n
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
WIDTH = KINDS * KINDS + 4


def held_out(doc_id: Column) -> Column:
    """The rows that no training may see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _repeated(words: list[bytes]) -> np.ndarray:
    """Which words lie in a five-word window that occurs twice or more."""
    out = np.zeros(len(words) + 1, dtype=np.int64)
    n = len(words) - WINDOW + 1
    if n > 1:
        h = np.fromiter(map(hash, words), dtype=np.int64, count=len(words))
        window = np.zeros(n, dtype=np.int64)
        for k in range(WINDOW):
            window = window * np.int64(0x2545F4914F6CDD1D) + h[k:k + n]
        order = np.argsort(window, kind="stable")
        equal = window[order[1:]] == window[order[:-1]]
        twice = np.unique(np.concatenate([order[1:][equal], order[:-1][equal]]))
        out[twice] += 1
        np.subtract.at(out, twice + WINDOW, 1)
    return np.cumsum(out[:-1]) > 0


def encode(text: bytes, passage: int = PASSAGE) -> np.ndarray:
    """The encodings of all passages of a text."""
    words = text.split()
    if not words:
        return np.zeros((1, WIDTH), dtype=np.float32)
    data = np.frombuffer(text, dtype=np.uint8)
    space = _SPACE[data]
    begins = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))[::passage]
    begins[0] = 0
    n = len(begins)
    bounds = np.append(begins, len(data))
    sizes = np.diff(bounds)
    out = np.empty((n, WIDTH), dtype=np.float32)
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        kind = np.append(_KIND[data[bounds[lo]:bounds[hi] + 1]], 0)  # and the one behind the block
        size = bounds[hi] - bounds[lo]
        pair = kind[:size] * KINDS + kind[1:size + 1]
        pair += np.repeat(np.arange(hi - lo) * (KINDS * KINDS), sizes[lo:hi])
        counts = np.bincount(pair, minlength=(hi - lo) * KINDS * KINDS).reshape(hi - lo, KINDS * KINDS)
        out[lo:hi, :-4] = np.sqrt(counts / sizes[lo:hi, None])
    starts = np.arange(0, len(words), passage)
    own = np.diff(np.append(starts, len(words)))
    out[:, -4] = np.add.reduceat(_repeated(words).astype(np.float32), starts) / own
    out[:, -3] = np.log1p(np.add.reduceat(np.fromiter(map(len, words), dtype=np.float32, count=len(words)), starts) / own)
    out[:, -2] = np.log1p(own)
    out[:, -1] = np.log1p(len(words))
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def _forward(self, x: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
        """Everything from encodings (already scaled) to scores; ``starts``: the first
        passage of each document."""
        w = self.weights
        e = np.tanh(x @ w["encode"] + w["encode0"])
        t, g = np.tanh(e @ w["tanh"]), _sigmoid(e @ w["gate"])
        strength = (t * g) @ w["attend"]
        sizes = np.diff(np.append(starts, len(x)))
        raised = np.exp(strength - np.repeat(np.maximum.reduceat(strength, starts), sizes))
        a = raised / np.repeat(np.add.reduceat(raised, starts), sizes)
        z = np.add.reduceat(a[:, None] * e, starts, axis=0)
        return {"e": e, "t": t, "g": g, "a": a, "z": z, "sizes": sizes, "score": _sigmoid(z @ w["score"] + w["score0"])}

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5)

    def score(self, x: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self._forward(self.scaled(x), starts)["score"]

    def attention(self, x: np.ndarray) -> np.ndarray:
        """How much each passage of one document counts."""
        return self._forward(self.scaled(x), np.zeros(1, dtype=np.int64))["a"]

    def gradients(self, x: np.ndarray, starts: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss; ``x`` already scaled."""
        w, f = self.weights, self._forward(x, starts)
        e, t, g, a = f["e"], f["t"], f["g"], f["a"]
        error = (f["score"] - y) / len(y)
        dz = np.repeat(error[:, None] * w["score"], f["sizes"], axis=0)
        da = (dz * e).sum(axis=1)
        strength = a * (da - np.repeat(np.add.reduceat(a * da, starts), f["sizes"]))
        dt = strength[:, None] * w["attend"] * g * (1 - t * t)
        dg = strength[:, None] * w["attend"] * t * g * (1 - g)
        de = (a[:, None] * dz + dt @ w["tanh"].T + dg @ w["gate"].T) * (1 - e * e)
        return {"encode": x.T @ de, "encode0": de.sum(axis=0), "tanh": e.T @ dt, "gate": e.T @ dg, "attend": (t * g).T @ strength,
                "score": f["z"].T @ error, "score0": error.sum(keepdims=True)}


def fit(bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS, seed: int = 17) -> Model:
    """A model from the encodings of each document and its label."""
    rng = np.random.default_rng(seed)
    every = np.concatenate(bags).astype(np.float64)
    model = Model(every.mean(axis=0), every.std(axis=0) + 0.01, {
        "encode": rng.normal(0, WIDTH ** -0.5, (WIDTH, HIDDEN)), "encode0": np.zeros(HIDDEN), "tanh": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATES)),
        "gate": rng.normal(0, HIDDEN ** -0.5, (HIDDEN, GATES)), "attend": rng.normal(0, GATES ** -0.5, GATES),
        "score": rng.normal(0, HIDDEN ** -0.5, HIDDEN), "score0": np.zeros(1)})
    bags = [model.scaled(b) for b in bags]
    first = {k: np.zeros_like(v) for k, v in model.weights.items()}
    second = {k: np.zeros_like(v) for k, v in model.weights.items()}
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for lo in range(0, len(order), BATCH):
            own = order[lo:lo + BATCH]
            starts = np.cumsum([0] + [len(bags[i]) for i in own[:-1]])
            slopes = model.gradients(np.concatenate([bags[i] for i in own]), starts, labels[own])
            step += 1
            for k, v in model.weights.items():
                d = slopes[k] + DECAY * v
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                v -= RATE * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.999 ** step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | float:
    """A model from the labelled rows of ``docs`` (doc_id, text) that are not held out; the
    share of label 1 where only one class is labelled."""
    marked = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for text in batch.column(1):
                bag = encode(text.as_buffer().to_pybytes() if text.is_valid else b"")
                if len(bag) > TRAIN_PASSAGES:
                    bag = bag[np.arange(TRAIN_PASSAGES) * len(bag) // TRAIN_PASSAGES]
                bags.append(bag.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bags, pa.binary())], ["quality", "bag"])

    # One of several rows of a doc_id, so that the sample stays bounded.
    once = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    found = sorted(zip(*map(list, map_batches(once.select("quality", "text"), encoded, "quality int, bag binary").toArrow().to_pydict().values()), strict=True))
    y = np.array([q for q, _ in found], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return float(y.mean()) if len(y) else 0.5
    return fit([np.frombuffer(b, dtype=np.float32).reshape(-1, WIDTH) for _, b in found], y)


def score(docs: DataFrame, model: Model | float, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for text in batch.column(1):
                if isinstance(model, Model):
                    bag = encode(text.as_buffer().to_pybytes() if text.is_valid else b"")
                    values.append(float(model.score(bag, np.zeros(1, dtype=np.int64))[0]))
                else:
                    values.append(model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = map_batches(docs.select("doc_id", F.col("text").cast("string")), scored, f"doc_id {kind}, score double")
    scores = scores.withColumn("score", F.round("score", 9))
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
