"""Quality scores: random-indexing word vectors, pooled, into a two-layer network.

Each word has a sparse ternary index vector that its hash fixes. A word's
context vector is the sum of the index vectors of its neighbours over the whole
corpus. A document is the mean of its words' vectors (context and index), the
length of that mean and the mean likeness of neighbouring words. A two-layer
numpy network scores it; one temperature, fitted on rows that training did not
see, calibrates the probability.

Bounds: words share ``BUCKETS`` hash buckets, so the context table has a fixed
size; every task adds up its own table before anything is shuffled, and whole
texts of all documents count. The network is fitted on at most ``per_class``
labelled documents of each class whose crc32(doc_id) leaves another remainder
than the held-out one. Labels, ids, languages and sources are no inputs.

Defined results: null and empty texts have zero vectors and get the network's
score for them; with no labels, or labels of one class, every score is 0.5, or
near that class; rows are independent, so repeated rows get equal scores; other
columns pass through unless they clash with the added ones, which win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import text_or_empty
from martlake.llm.flat import chunks, mix, small_batches
from martlake.llm.labelled import sample
from martlake.llm.tokens import Tokens

BUCKETS, WIDTH, NONZERO, REACH = 1 << 13, 32, 4, 2
BLOCK = 64  # buckets in one row of the context table while it is summed
HELD_OUT_OF, HELD_OUT = 3, 1
PER_CLASS = 8000
HIDDEN = 32
SLICE = 1 << 16  # words whose vectors are pooled at once


def held_out(doc_id: Column) -> Column:
    """Whether a document's label is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % HELD_OUT_OF == HELD_OUT, F.lit(False))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Dimensions and signs of the nonzero entries of each bucket's index vector."""
    words = mix(np.arange(BUCKETS * NONZERO, dtype=np.uint64) + np.uint64(977)).reshape(BUCKETS, NONZERO)
    return (words % np.uint64(WIDTH)).astype(np.int64), np.where(words >> np.uint64(40) & np.uint64(1), 1.0, -1.0)


def _buckets(texts: list[str]) -> tuple[np.ndarray, Tokens]:
    tokens = Tokens(texts)
    return (tokens.hashes() % np.uint64(BUCKETS)).astype(np.int64), tokens


def context_table(docs: DataFrame) -> np.ndarray:
    """The context vectors of all buckets, summed over all documents."""
    rows = docs.select(text_or_empty().alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dims, signs = index_vectors()
        table = np.zeros(BUCKETS * WIDTH)
        for batch in small_batches(batches):
            texts = batch.column(0).to_pylist()
            for a, b in chunks(texts):
                bucket, tokens = _buckets(texts[a:b])
                for reach in range(1, REACH + 1):
                    near = tokens.text[reach:] == tokens.text[: max(0, len(bucket) - reach)]
                    left, right = bucket[:-reach][near], bucket[reach:][near]
                    for this, other in ((left, right), (right, left)):
                        for k in range(NONZERO):
                            table += np.bincount(this * WIDTH + dims[other, k], weights=signs[other, k], minlength=len(table))
        blocks = table.astype(np.int64).reshape(BUCKETS // BLOCK, -1)
        full = np.flatnonzero(blocks.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([blocks[i].tobytes() for i in full], pa.binary())], ["block", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}  # at most all blocks of one table
        for batch in batches:
            for block, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[block] = total.get(block, 0) + np.frombuffer(sums, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["block", "sums"])

    parts = rows.mapInArrow(count, "block long, sums binary").repartition("block").mapInArrow(add, "block long, sums binary")
    table = np.zeros((BUCKETS // BLOCK, BLOCK * WIDTH))
    for row in parts.collect():  # one table of fixed size
        table[row["block"]] = np.frombuffer(bytes(row["sums"]), np.int64)
    return table.reshape(BUCKETS, WIDTH)


def word_vectors(table: np.ndarray) -> np.ndarray:
    """Unit context vectors beside index vectors."""
    dims, signs = index_vectors()
    index = np.zeros((BUCKETS, WIDTH))
    np.add.at(index, (np.repeat(np.arange(BUCKETS), NONZERO), dims.ravel()), signs.ravel())
    parts = [x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9) for x in (table, index)]
    return np.hstack(parts).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray) -> np.ndarray:
    """A document's mean vector, that vector's length, and the mean likeness of neighbours."""
    width = vectors.shape[1]
    out = np.zeros((len(texts), width + 2))
    for a, b in chunks(texts):
        bucket, tokens = _buckets(texts[a:b])
        size = np.maximum(np.diff(tokens.bounds), 1)
        sums, like = np.zeros((b - a, width)), np.zeros(b - a)
        for at in range(0, len(bucket), SLICE):
            own = vectors[bucket[at : at + SLICE + 1]]
            text = tokens.text[at : at + SLICE + 1]
            same = np.flatnonzero(text[1:] == text[:-1])
            like += np.bincount(text[same], weights=(own[same] * own[same + 1]).sum(1), minlength=b - a)
            own, text = own[:SLICE], text[:SLICE]
            first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            sums[text[first]] += np.add.reduceat(own, first, axis=0)
        mean = sums / size[:, None]
        out[a:b] = np.column_stack([mean, np.linalg.norm(mean, axis=1), like / np.maximum(size - 1, 1)])
    return out


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    layers: tuple
    temperature: float
    both_classes: bool = True  # whether it was fitted on documents of both

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(logits(self.layers, (features - self.shift) / self.scale) / self.temperature, -500, 500)))


def logits(layers: tuple, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    return np.tanh(x @ w1 + b1) @ w2 + b2


def fit_network(x: np.ndarray, y: np.ndarray, rounds: int = 600, rate: float = 0.01, ridge: float = 1e-4) -> tuple:
    """Two layers by Adam on all rows; both classes weigh alike."""
    rng = np.random.default_rng(7)
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    mean, square = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
    for step in range(1, rounds + 1):
        w1, b1, w2, b2 = layers
        h = np.tanh(x @ w1 + b1)
        off = (1 / (1 + np.exp(-np.clip(h @ w2 + b2, -500, 500))) - y) * weight
        back = np.outer(off, w2) * (1 - h**2)
        grads = [x.T @ back + ridge * w1, back.sum(0), h.T @ off + ridge * w2, off.sum()]
        for k, g in enumerate(grads):
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g**2
            layers[k] = layers[k] - rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-9)
    return tuple(layers)


def fit_temperature(logit: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))

    def loss(log_t: float) -> float:
        z = np.where(y == 1, logit, -logit) / np.exp(log_t)
        return float((np.logaddexp(0, -z) * weight).sum())

    lo, hi, golden = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    while hi - lo > 1e-4:
        a, b = hi - golden * (hi - lo), lo + golden * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = PER_CLASS) -> Model:
    """Word vectors from all documents; network and temperature from a bounded sample."""
    vectors = word_vectors(context_table(docs))
    rows = sample(docs, labels, label, per_class, ~held_out(F.col("doc_id")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "features": list(pooled(batch["text"].tolist(), vectors))})

    data = rows.mapInPandas(run, "doc_id long, label int, features array<double>").toPandas().sort_values("doc_id", kind="stable")
    width = vectors.shape[1] + 2
    if data["label"].nunique() < 2:
        base = 0.0 if data.empty else 10.0 * (2 * int(data["label"].iloc[0]) - 1)
        flat = (np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), np.float64(base))
        return Model(vectors, np.zeros(width), np.ones(width), flat, 1.0, both_classes=False)
    x, y = np.array(data["features"].tolist()), data["label"].to_numpy()
    shift, scale = x.mean(0), x.std(0) + 1e-6
    x = (x - shift) / scale
    aside = mix(data["doc_id"].to_numpy().astype(np.uint64)) % np.uint64(5) == 0  # for the temperature
    if len(np.unique(y[aside])) < 2 or len(np.unique(y[~aside])) < 2:
        layers, temperature = fit_network(x, y), 1.0
    else:
        layers = fit_network(x[~aside], y[~aside])
        temperature = fit_temperature(logits(layers, x[aside]), y[aside])
    return Model(vectors, shift, scale, layers, temperature)


def with_score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds score (0 to 1, higher for better text) and predicted (1 from 0.5 on)."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(pooled(texts.tolist(), model.vectors)))

    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = docs.select(*others, score(text_or_empty()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
