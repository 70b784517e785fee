"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled text, one of toxic and one of
ordinary documents.  A window (a word or the beginning of one, framed by repetition so
that its own cost shows) is compressed with both; the difference of the two
lengths says which text it resembles.  Words whose largest gap reaches ``MIN_GAP`` count; a calibrated
logistic function of their number, sum and largest gap gives the score.

Training, on rows that the caller names as trainable:

* the content of the toxic dictionary is chosen by counting, over the labelled
  documents and per class, in how many texts a word or word beginning occurs;
  those over-represented in toxic text (G-squared above ``MIN_EVIDENCE``) go in,
  the strongest nearest to the end, where matches cost least; of a beginning and
  its continuations only the strongest;
* the content of the ordinary dictionary is the words and beginnings that most
  ordinary documents hold; the toxic one begins with the same, as toxic documents
  are mostly ordinary text too;
* the logistic function is fitted to the labelled documents themselves, each class
  with the weight that it has among all trainable labels.

At most ``SAMPLE`` labelled documents of each class are used (those whose hashed
id comes first); the weights undo what that does to the mix of the classes, so
a threshold means the same however large the table is.  So what reaches the driver is bounded: ``DICTIONARY_ENTRIES``
strings, and four numbers for each sampled document.  Scoring reads every whole
text, row by row, without a shuffle.

Defined cases: a null or empty text has no windows and gets the score of a text
without evidence; very long texts are scored whole; words of more than ``KEEP_CHARS``
characters are scored by their beginnings and never become dictionary entries; entries of equal
evidence (ties) go by length, then alphabetically; repeated rows are scored one by one (training takes
one of several copies or near copies, the smallest text); without labels of both classes every score
is 0; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_batches

SAMPLE = 4000
DICTIONARY_ENTRIES = 256
#: Windows that compete for them, the strongest first.
CANDIDATES = 8192
ORDINARY_ENTRIES = 2000
MIN_EVIDENCE = 25.0
MIN_DOCUMENTS = 3
PREFIXES = (4, 5, 6, 7)
MIN_GAP = 3
THRESHOLD = 0.3
FEATURES = 4
KEEP_WINDOWS = 400_000
KEEP_CHARS = 64
_PARAMETERS = dict(strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=17, hash_log=14, chain_log=14, search_log=5,
                   target_length=64, write_content_size=False, write_dict_id=False, write_checksum=False,
                   format=zstandard.FORMAT_ZSTD1_MAGICLESS)


def held_out(doc_id: Column) -> Column:
    """The rows that no training may see."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Distance:
    """Length gap of a window between the two dictionaries."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        raw = zstandard.DICT_TYPE_RAWCONTENT
        parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
        self._toxic, self._ordinary = (
            zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d, dict_type=raw), compression_params=parameters).compress
            for d in (toxic, ordinary))
        self._known: dict[str, int] = {}
        self._windows: dict[str, int] = {}

    def gap(self, word: str) -> int:
        """The largest gap among a word and its beginnings."""
        found = self._known.get(word)
        if found is None:
            found = max(map(self._gap, {word, *(word[:n] for n in PREFIXES)}))
            if len(word) <= KEEP_CHARS:
                if len(self._known) >= KEEP_WINDOWS:
                    self._known.clear()
                self._known[word] = found
        return found

    def _gap(self, window: str) -> int:
        found = self._windows.get(window)
        if found is None:
            framed = f" {window} ".encode("utf-8", "surrogatepass") * 3
            found = len(self._ordinary(framed)) - len(self._toxic(framed))
            if len(window) <= KEEP_CHARS:
                if len(self._windows) >= KEEP_WINDOWS:
                    self._windows.clear()
                self._windows[window] = found
        return found

    def figures(self, text: str) -> tuple[float, ...]:
        """Number and sum of the gaps that count, the largest, and the windows."""
        words = text.lower().split()
        strong = [g for g in map(self.gap, words) if g >= MIN_GAP]
        return float(len(strong)), float(sum(strong)), float(max(strong, default=0)), float(len(words))


def features(figures: np.ndarray, rate: float) -> np.ndarray:
    """What the logistic function sees.  ``rate``: the share of windows of
    ordinary text that count, so that long texts are allowed a few."""
    count, total, largest, n = figures.T
    chance = rate * n
    return np.column_stack([(count - chance) / np.sqrt(chance + 0.25), np.log1p(total) - np.log1p(chance), largest,
                            np.log1p(100 * count / (n + 20))])


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    rate: float
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one is the intercept

    def score(self, figures: np.ndarray) -> np.ndarray:
        z = ((features(figures, self.rate) - self.mean) / self.scale) @ self.weights[:-1] + self.weights[-1]
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 50,
                 stands_for: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and weights, by Newton steps.  ``stands_for``: how many rows
    each one stands for, in proportion."""
    n = np.ones(len(x)) if stands_for is None else stands_for * len(x) / stands_for.sum()
    mean = np.average(x, 0, n)
    scale = np.sqrt(np.average((x - mean) ** 2, 0, n)) + 1e-9
    a = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    penalty = np.diag([ridge] * x.shape[1] + [1e-6])
    w = np.zeros(a.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a.T * (n * np.maximum(p * (1 - p), 1e-9))) @ a + penalty, a.T @ (n * (y - p)) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return mean, scale, w


def _dictionary(entries: list[str]) -> bytes:
    """The strongest entry last, before some bytes that zstandard never looks up."""
    return ("".join(f" {e} " for e in reversed(entries)) + " " * 16).encode()


def _beginnings(words: Column, n: int) -> Column:
    return F.transform(F.filter(words, lambda w: F.length(w) > n), lambda w: F.substring(w, 1, n))


def evidence(toxic_with: Column, toxic_all: int, ordinary_with: Column, ordinary_all: int) -> Column:
    """G-squared of a window that occurs more often in toxic documents."""
    total = toxic_all + ordinary_all
    seen = toxic_with + ordinary_with

    def part(n: Column, share: float) -> Column:
        return F.when(n > 0, n * F.log(n / (seen * share))).otherwise(0.0)

    return 2 * (part(toxic_with, toxic_all / total) + part(ordinary_with, ordinary_all / total))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """A model from the labelled rows of ``docs`` (doc_id, text) that are not held out."""
    marked = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    trainable = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    # The first ids of each class, before any text is read.
    chosen = marked.filter("toxic = 1").orderBy(order).limit(sample).unionByName(marked.filter("toxic = 0").orderBy(order).limit(sample))
    rows = docs.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")
    # One text of each group of (near) copies: the lowest hash of its five-word
    # windows is what they most likely share.
    rows = rows.withColumn("said", F.split(F.lower("text"), r"\s+"))
    lowest = F.array_min(F.transform("said", lambda _, i: F.xxhash64(F.slice(F.col("said"), i + 1, F.lit(5)))))
    rows = rows.withColumn("copy", lowest).groupBy("copy").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).persist()
    try:
        sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        if len(sizes) < 2:
            return None
        said = F.array_distinct(F.filter(F.split(F.lower("text"), r"\s+"), lambda w: (F.length(w) > 0) & (F.length(w) <= KEEP_CHARS)))
        starts = F.array_distinct(F.flatten(F.array(said, *[_beginnings(said, n) for n in PREFIXES])))
        counts = (rows.select("toxic", F.explode(starts).alias("window")).groupBy("window")
                  .agg(F.sum("toxic").cast("double").alias("t"), F.sum(1 - F.col("toxic")).cast("double").alias("o")))
        strength = evidence(F.col("t"), sizes[1], F.col("o"), sizes[0])
        more = counts.filter((F.col("t") >= MIN_DOCUMENTS) & (F.col("t") * sizes[0] > F.col("o") * sizes[1])).withColumn("g", strength)
        strongest = more.filter(F.col("g") > MIN_EVIDENCE).orderBy(F.desc("g"), F.desc(F.length("window")), "window")
        # A word and its beginnings are one entry, so that each place goes to a stem of its own.
        toxic: list[str] = []
        for r in strongest.limit(CANDIDATES).collect():
            if len(toxic) < DICTIONARY_ENTRIES and not any(r["window"].startswith(w) or w.startswith(r["window"]) for w in toxic):
                toxic.append(r["window"])
        ordinary = [r["window"] for r in counts.orderBy(F.desc("o"), "window").limit(ORDINARY_ENTRIES).collect()]
        ordinary_bytes = _dictionary(ordinary)
        # Toxic documents are mostly ordinary text too.
        toxic_bytes = ordinary_bytes + _dictionary(toxic)
        found = map_batches(rows.select("toxic", "text"),
            _figures_of(toxic_bytes, ordinary_bytes), "toxic int, figures array<double>").toArrow()
    finally:
        rows.unpersist()
    x = np.array(found["figures"].to_pylist(), dtype=float).reshape(-1, FEATURES)
    y = np.array(found["toxic"].to_pylist(), dtype=float)
    rate = float((x[y == 0, 0].sum() + 1) / (x[y == 0, 3].sum() + 1000))
    # A class whose sample is capped counts as much as all its labels do.
    ordinary_each, toxic_each = (max(1.0, trainable[c] / sample) for c in (0, 1))
    mean, scale, weights = fit_logistic(features(x, rate), y, stands_for=np.where(y == 1, toxic_each, ordinary_each))
    return Model(toxic_bytes, ordinary_bytes, rate, mean, scale, weights)


def _figures_of(toxic: bytes, ordinary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(toxic, ordinary)
        for batch in batches:
            rows = [distance.figures(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], ["toxic", "figures"])

    return run


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        distance = Distance(model.toxic, model.ordinary) if model else None
        for batch in batches:
            values = np.zeros(batch.num_rows)
            if distance and batch.num_rows:
                values = model.score(np.array([distance.figures(t.as_py() or "") for t in batch.column(1)]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scores = map_batches(docs.select("doc_id", F.col("text").cast("string")), scored, f"doc_id {kind}, score double")
    return scores.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
