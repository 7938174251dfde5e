"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the hashed n-grams of characters that a text holds (whether, not how often); no
gram is left out. Their ratio r = log of the share of toxic over the share of clean training
documents that hold them scales them; a logistic regression on the scaled features gives the
weights. Training reads at most MAX_PER_CLASS labelled documents of either class, those with the
smallest hashes of their ids, so it fits one task; the model is a table of fixed size, whatever
the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.common import hash_share, small_batches, written

GRAMS = (3, 4, 5)
#: Places of the table that grams are hashed to.
BITS = 20
#: Labelled documents of a class that training reads: the bound of the sample.
MAX_PER_CLASS = 2500
FOLDS = 5
#: Characters of a text that are hashed at once.
PIECE = 1 << 18
#: Documents whose products training holds at once.
BLOCK = 2048
#: What is added to each share of a class.
SMOOTH = 0.02

_FOLD = np.arange(128, dtype=np.uint32)
_FOLD[65:91] += 32
_FOLD[[9, 10, 11, 12, 13]] = 32
_scratch = np.zeros(1 << BITS, dtype=np.int32)


def _distinct(v: np.ndarray) -> np.ndarray:
    """Each value once, the last of each, without sorting."""
    n = np.arange(len(v), dtype=np.int32)
    _scratch[v] = n
    return v[_scratch[v] == n]


def features(text: str | None) -> np.ndarray:
    """The distinct hashed n-grams of a text: A-Z are lowered, ASCII white space is a space, and a
    space stands at both ends."""
    points = np.frombuffer(f" {text or ' '} ".encode("utf-32-le", "surrogatepass"), dtype="<u4")
    raw = np.where(points < 128, _FOLD[np.minimum(points, 127)], points).astype(np.uint32)
    found = []
    for at in range(0, len(raw), PIECE):
        x = raw[at : at + PIECE + max(GRAMS) - 1]
        h, grams = np.zeros(len(x), dtype=np.uint32), []
        for k in range(max(GRAMS)):
            h = h[: len(x) - k] * np.uint32(0x01000193) + x[k:]
            if k + 1 in GRAMS and len(h):
                grams.append(((h ^ np.uint32(k)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS))
        if grams:
            found.append(_distinct(np.concatenate(grams)))
    return found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint32)


@dataclass
class Model:
    """weights: of the places that grams are hashed to."""

    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        z = self.bias + float(self.weights[features(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no rest by FOLDS; null ids are held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> DataFrame:
    """(text, toxic) of the sample. An id labelled both ways counts as toxic; null labels do not count.

    The sampled ids are at most twice max_per_class, so they may be broadcast to the texts.
    """
    own = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    own = own.where(~held_out(F.col("doc_id")))
    order = [F.xxhash64("doc_id", F.lit(3)), F.col("doc_id")]
    sizes = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = [own.where((F.col("toxic") == y) & hash_share(F.col("doc_id"), max_per_class, sizes.get(y, 0))) for y in (0, 1)]
    some = [df.orderBy(*order).limit(max_per_class) for df in few]
    return docs.select("doc_id", "text").join(F.broadcast(some[0].union(some[1])), "doc_id").select("text", "toxic")


def ratios(xs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Log of the share of toxic over the share of clean documents that hold a feature, both
    smoothed alike, so that rare features of the smaller class don't stand out."""
    held = np.zeros((2, 1 << BITS))
    for x, toxic in zip(xs, y, strict=True):
        held[int(toxic), x] += 1
    return np.log(held[1] / (y == 1).sum() + SMOOTH) - np.log(held[0] / (y == 0).sum() + SMOOTH)


def fit(xs: list[np.ndarray], y: np.ndarray, r: np.ndarray, rounds: int = 40, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on the features scaled by r, by accelerated gradient steps: the weights of
    the features themselves, and the bias. Mean loss plus half the penalty times the squared weights."""
    n = len(y)
    blocks = []
    for at in range(0, n, BLOCK):
        part = xs[at : at + BLOCK]
        sizes = np.array([len(x) for x in part])
        blocks.append((at, np.concatenate(part).astype(np.int32), np.cumsum(sizes) - sizes, sizes))
    mean = sum(float((r[idx] ** 2).sum()) for _, idx, _, _ in blocks) / n
    rate = 4.0 / (mean + 1 + 4 * penalty)
    w, v, b, c = np.zeros(len(r)), np.zeros(len(r)), 0.0, 0.0
    for t in range(rounds):
        m = t / (t + 3)
        wn, bn = w + m * (w - v), b + m * (b - c)
        scaled, slope, total = wn * r, np.zeros(len(r)), 0.0
        for at, idx, starts, sizes in blocks:
            z = np.add.reduceat(scaled[idx], starts) + bn  # each text has a gram
            g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[at : at + len(sizes)]) / n
            slope += np.bincount(idx, np.repeat(g, sizes), minlength=len(r))
            total += g.sum()
        v, c = w, b
        w, b = wn - rate * (slope * r + penalty * wn), bn - rate * total
    return w * r, float(b)


def trained(docs: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> Model:
    """A model of labels.toxic. With rows of one class only, every text scores that class's smoothed share."""
    small_batches(docs.sparkSession)
    sample = written(training_rows(docs, labels, max_per_class).repartition(12), "toxicity-sample")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [features(t.as_py()).astype("<i4").tobytes() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), b.column(1)], ["x", "toxic"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, y = [], []
        for b in batches:
            xs += [np.frombuffer(x.as_buffer(), dtype="<i4") for x in b.column(0)]
            y += b.column(1).to_pylist()
        y = np.array(y, dtype=float)
        toxic, clean = int((y == 1).sum()), int((y == 0).sum())
        if toxic and clean:
            weights, bias = fit(xs, y, ratios(xs, y))
        else:
            share = (toxic + 1) / (clean + toxic + 2)
            weights, bias = np.zeros(1 << BITS), float(np.log(share / (1 - share)))
        yield pa.RecordBatch.from_arrays([pa.array([weights.astype("<f4").tobytes()], pa.binary()), pa.array([bias])], ["weights", "bias"])

    rows = written(sample.mapInArrow(vectors, "x binary, toxic int"), "toxicity-vectors")
    # The sample is bounded, so one task may have all of it; rows come in one order.
    got = written(rows.coalesce(1).sortWithinPartitions("x").mapInArrow(learn, "weights binary, bias double"), "toxicity-model").first()
    return Model(np.frombuffer(got["weights"], dtype="<f4"), got["bias"]) if got else Model(np.zeros(1 << BITS, dtype="<f4"), 0.0)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted) of every row of docs (doc_id, text); other columns are not read.

    Null and empty texts score as a text without features. Repeated rows come out as often.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            s = pa.array([m.score(t.as_py()) for t in b.column(1)], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), s], ["doc_id", "score"])

    got = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
    return got.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, whose texts score below the threshold."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.score(t.as_py()) < threshold for t in b.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
