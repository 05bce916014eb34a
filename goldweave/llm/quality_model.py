"""Quality classifier: random-indexing word vectors, pooled per document, under
a two-layer network with calibrated probabilities.

Words (runs of letters, of digits, of signs, with their case) have a slot in a
table of fixed size. Every slot has a random index vector, sparse and ternary;
a word's context vector is the sum of the index vectors of its neighbours in
the fitting sample. A document is the mean of the context vectors of its words;
a word that repeats the one before it also counts as the word `<again>`.

A network of two layers (numpy, tanh, Adam) maps the mean to a logit. It is
fitted on `fit_rows` labelled documents at most, the first by a digest of their
id, never on held-out ones; a fifth of them sets the temperature by which
logits are divided. Everything sent to the driver has a fixed size: one table
of vectors from each of `fit_parts` tasks, one vector per fitting document.

Scoring is one pass over all texts, whole texts, nothing shuffled.

Defined results: null and empty texts have the zero vector and get its score;
labels that are null do not count, several for one id are averaged; without
labels of both kinds every score is the share of label 1 (0.5 without any); an
empty table gives an empty result; repeated rows get equal scores; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.storage import written
from .text import whole

WORD = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+")


@dataclass(frozen=True)
class Setup:
    slots: int = 1 << 14
    width: int = 64
    window: int = 2
    hidden: int = 32
    fit_rows: int = 6_000
    fit_parts: int = 8
    epochs: int = 60
    seed: int = 11


class Slots(dict):
    """Slot of a word, remembered. Words are told by case, a stem of six
    letters, and the first signs of a run of signs."""

    def __init__(self, slots: int) -> None:
        super().__init__()
        self.slots = slots

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        case = "U" if word.isupper() and len(word) > 1 else "T" if word[0].isupper() else "l"
        form = case + word.lower()[:6] if word[0].isalpha() else "0" if word[0].isdigit() else word[:3]
        slot = self[word] = 1 + crc32(form.encode("utf-8", "surrogatepass")) % (self.slots - 1)
        return slot


def slots_of(text: str, table: Slots) -> np.ndarray:
    found = WORD.findall(text)
    ids = np.fromiter(map(table.__getitem__, found), np.int64, len(found))
    again = int((ids[1:] == ids[:-1]).sum())
    return np.concatenate([ids, np.zeros(again, np.int64)]) if again else ids


def index_vectors(setup: Setup) -> np.ndarray:
    rng = np.random.default_rng(setup.seed)
    out = np.zeros((setup.slots, setup.width), np.float32)
    for sign in (1, -1):
        for _ in range(3):
            out[np.arange(setup.slots), rng.integers(0, setup.width, setup.slots)] += sign
    return out


def pooled(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    total = np.zeros(vectors.shape[1], np.float64)
    for at in range(0, len(ids), 50_000):
        total += vectors[ids[at:at + 50_000]].sum(axis=0)
    return total / max(len(ids), 1)


def fitting_sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows: int) -> DataFrame:
    """(text, y, order) of at most `rows` labelled documents, in the order of a
    digest of their id. The ids are few and go to every task."""
    order = F.md5(F.col("doc_id").cast("string"))
    marked = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out)
        .groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("y"))
        .withColumn("order", order).orderBy("order").limit(rows)
    )
    return written(docs.select("doc_id", whole(F.col("text")).alias("text")).join(
        F.broadcast(marked), "doc_id").select("text", "y", "order"), "fitting-sample")


def context_vectors(sample: DataFrame, setup: Setup) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, table = index_vectors(setup), Slots(setup.slots)
        total = np.zeros_like(index)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = slots_of(text, table)
                for at in range(0, len(ids), 20_000):
                    part = ids[at:at + 20_000]
                    near = np.zeros((len(part), setup.width), np.float32)
                    for k in range(1, setup.window + 1):
                        near[k:] += index[part[:-k]]
                        near[:-k] += index[part[k:]]
                    order = np.argsort(part, kind="stable")
                    own, first = np.unique(part[order], return_index=True)
                    total[own] += np.add.reduceat(near[order], first, axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    vectors = np.zeros((setup.slots, setup.width), np.float32)
    for row in sample.select("text").repartition(setup.fit_parts).mapInArrow(run, "v binary").toLocalIterator():
        vectors += np.frombuffer(row["v"], np.float32).reshape(vectors.shape)
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    # slots that the sample never saw keep their own index vector
    index = index_vectors(setup)
    out = np.where(norm > 0, vectors / np.maximum(norm, 1e-9), 0) + 0.5 * index / np.sqrt(6)
    return out.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logits(x) / self.temperature)


def fit(x: np.ndarray, y: np.ndarray, setup: Setup) -> Network:
    """Rows must come in a fixed order; every fifth sets the temperature."""
    rng = np.random.default_rng(setup.seed)
    check = np.arange(len(y)) % 5 == 4
    if len(np.unique(y[~check])) < 2 or len(np.unique(y[check])) < 2:
        check = np.zeros(len(y), bool)
    train = np.flatnonzero(~check)
    mean, scale = x[train].mean(axis=0), x[train].std(axis=0) + 1e-3
    z = (x - mean) / scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], setup.hidden)), np.zeros(setup.hidden),
         rng.normal(0, 1 / np.sqrt(setup.hidden), setup.hidden), np.zeros(1)]
    moment = [[np.zeros_like(v), np.zeros_like(v)] for v in p]
    step = 0
    for _ in range(setup.epochs):
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 64)):
            h = np.tanh(z[part] @ p[0] + p[1])
            d = (_sigmoid(h @ p[2] + p[3][0]) - y[part]) / len(part)
            back = np.outer(d, p[2]) * (1 - h * h)
            grads = [z[part].T @ back + 1e-4 * p[0], back.sum(axis=0), h.T @ d + 1e-4 * p[2], np.array([d.sum()])]
            step += 1
            for v, g, m in zip(p, grads, moment):
                m[0] += 0.1 * (g - m[0])
                m[1] += 0.001 * (g * g - m[1])
                v -= 0.003 * (m[0] / (1 - 0.9 ** step)) / (np.sqrt(m[1] / (1 - 0.999 ** step)) + 1e-8)
    model = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    rows = np.flatnonzero(check) if check.any() else train
    raw, best = model.logits(x[rows]), (np.inf, 1.0)
    for t in np.geomspace(0.25, 8, 60):
        s = np.clip(_sigmoid(raw / t), 1e-6, 1 - 1e-6)
        best = min(best, (float(-(y[rows] * np.log(s) + (1 - y[rows]) * np.log(1 - s)).mean()), float(t)))
    return Network(mean, scale, p[0], p[1], p[2], float(p[3][0]), best[1])


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column, label: str = "quality",
                   setup: Setup = Setup()) -> DataFrame:
    """doc_id, held_out, score, predicted for all documents."""
    spark = docs.sparkSession
    sample = fitting_sample(docs, labels, label, held_out, setup.fit_rows)
    vectors = context_vectors(sample, setup)
    # no more than the labels: documents with one id can be more
    limit = 2 * setup.fit_rows
    sent = spark.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Slots(setup.slots)
        for batch in batches:
            rows = [pooled(slots_of(t, table), sent.value) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.astype(np.float64).tobytes() for r in rows], pa.binary()), batch.column(1), batch.column(2)],
                names=["x", "y", "order"])

    rows = sample.mapInArrow(pool, "x binary, y int, order string").orderBy("order", "x").limit(limit).collect()
    y = np.array([r["y"] for r in rows], np.float64)
    model = None
    if len(np.unique(y)) == 2:
        model = fit(np.array([np.frombuffer(r["x"]) for r in rows]), y, setup)
    share = float(y.mean()) if len(y) else 0.5
    parts = None if model is None else (
        model.mean, model.scale, model.w1, model.b1, model.w2, model.b2, model.temperature)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Slots(setup.slots)
        network = None if parts is None else Network(*parts)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            if network is None or not texts:
                values = np.full(len(texts), share)
            else:
                values = network.score(np.array([pooled(slots_of(t, table), sent.value) for t in texts]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.float64())], names=["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), whole(F.col("text")).alias("text")).mapInArrow(
        score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def remainder(divisor: int, value: int) -> Column:
    """Held-out test: crc32 of the id as text has this remainder."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == value
