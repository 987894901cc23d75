"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are words and beginnings of words that mark toxic training documents,
counted on a log scale.
One set of weights gives a document's position on the severity scale; ordered
thresholds cut the scale into grades: P(grade > k) = sigmoid(w.x - theta_k).
The result is the chance of each grade and the expected severity.

Labels say toxic or not. The grades of toxic training documents are the thirds
of their summed log counts, so that grade 0 is clean and 1 to 3 grow more severe.

Bounds: the model is fitted on at most ``per_class`` labelled documents of each
class and has at most ``n_features`` features. Scoring reads every text whole.

Defined results: null and empty texts have no features and get the model's least
severity; with no labels, or labels of one class, every document gets grade 0 and
severity 0, or the chance of that class; rows are independent, so repeated rows
get equal results; other columns pass through unless they clash with the added
ones, which win.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.flat import chunks
from martlake.llm.labelled import label_counts, sample
from martlake.llm.tokens import Tokens

BEGINNINGS = (3, 4, 5, 6)  # lengths of word beginnings that are features beside the whole word
PER_CLASS = 6000
N_FEATURES = 1024
GRADES = 4
MARKER_ODDS = 2.0  # least log odds of a feature between toxic and clean training documents
REJECT_FROM = 0.5  # chance of a grade above 0


@dataclass(frozen=True)
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray
    both_classes: bool = True  # whether it was fitted on documents of both

    def grades(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Chance of each grade for n documents with sparse features."""
        score = np.bincount(rows, weights=values * self.weights[columns], minlength=n)
        above = sigmoid(score[:, None] - self.thresholds)
        edges = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        return edges[:, :-1] - edges[:, 1:]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words of texts, and the text of each."""
    tokens = Tokens(texts)
    length = (tokens.ends - tokens.starts)[tokens.is_word]
    text = tokens.text[tokens.is_word]
    found, of = [tokens.hashes()[tokens.is_word]], [text]
    for n in BEGINNINGS:
        longer = length > n
        found.append((tokens.hashes(n)[tokens.is_word][longer] ^ np.uint64(n)))
        of.append(text[longer])
    return np.concatenate(found), np.concatenate(of)


def sparse(texts: list[str], features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' log counts of the model's features: rows, columns, values."""
    found, of = _hashes(texts)
    if not len(features) or not len(found):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at = np.minimum(np.searchsorted(features, found), len(features) - 1)
    hit = features[at] == found
    cells, counts = np.unique(of[hit] * len(features) + at[hit], return_counts=True)
    return cells // len(features), cells % len(features), np.log1p(counts)


def _document_counts(rows: DataFrame) -> DataFrame:
    """In how many documents of each class a feature occurs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, label = batch["text"].tolist(), batch["label"].to_numpy()
            for a, b in chunks(texts):
                found, of = _hashes(texts[a:b])
                order = np.lexsort((of, found))
                found, of = found[order], of[order]
                new = np.append(True, (found[1:] != found[:-1]) | (of[1:] != of[:-1]))[: len(found)]
                found, toxic = found[new], label[a:b][of[new]]
                distinct, at = np.unique(found, return_inverse=True)
                yield pd.DataFrame({"feature": distinct.view(np.int64), "toxic": np.bincount(at, weights=toxic, minlength=len(distinct)).astype(np.int64), "n": np.bincount(at, minlength=len(distinct))})

    return rows.mapInPandas(run, "feature long, toxic long, n long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))


def _matrix(rows: DataFrame, features: np.ndarray) -> pd.DataFrame:
    """Labels and sparse features of the sample, on the driver; bounded by sample and features."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            for a, b in chunks(texts):
                row, column, value = sparse(texts[a:b], features)
                cut = np.searchsorted(row, np.arange(b - a + 1))
                yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[a:b].to_numpy(), "label": batch["label"].iloc[a:b].to_numpy(), "columns": [column[x:y] for x, y in zip(cut[:-1], cut[1:])], "values": [value[x:y] for x, y in zip(cut[:-1], cut[1:])]})

    out = rows.mapInPandas(run, "doc_id long, label int, columns array<long>, values array<double>").toPandas()
    return out.sort_values("doc_id", kind="stable", ignore_index=True)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = PER_CLASS, n_features: int = N_FEATURES) -> Model:
    """Fits the model on a bounded sample of the labelled documents."""
    rows = sample(docs, labels, label, per_class)
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, -20.0 if toxic else 20.0), both_classes=False)
    counts = _document_counts(rows)
    odds = F.log(((F.col("toxic") + 0.5) / (toxic + 1)) / ((F.col("n") - F.col("toxic") + 0.5) / (clean + 1)))
    gap = F.col("toxic") / toxic - (F.col("n") - F.col("toxic")) / clean
    # evidence for toxicity only: a text without any of it, such as an empty one, is clean
    best = counts.filter("toxic > 1").withColumn("odds", odds).filter(F.col("odds") > MARKER_ODDS).orderBy((gap * F.col("odds")).desc(), "feature").limit(n_features).collect()
    best.sort(key=lambda r: r["feature"] % (1 << 64))
    features = np.array([r["feature"] for r in best], np.int64).view(np.uint64)
    data = _matrix(rows, features)
    row = np.repeat(np.arange(len(data)), data["columns"].map(len))
    column = np.concatenate(data["columns"].tolist()).astype(np.int64) if len(row) else np.zeros(0, np.int64)
    value = np.concatenate(data["values"].tolist()) if len(row) else np.zeros(0)
    is_toxic = data["label"].to_numpy() == 1
    hits = np.bincount(row, weights=value, minlength=len(data))
    cuts = np.quantile(hits[is_toxic], [1 / 3, 2 / 3])
    grade = np.where(is_toxic, 1 + np.searchsorted(cuts, hits, side="left"), 0)
    # the sample may hold other shares of the classes than the labels do
    shares = {r["label"]: r["n"] for r in label_counts(docs, labels, label).collect()}
    weight = np.where(is_toxic, shares[1] / is_toxic.sum(), shares[0] / (~is_toxic).sum())
    weights, thresholds = fit_ordinal(row, column, value, grade, len(features), weight / weight.sum())
    return Model(features, weights, thresholds)


def fit_ordinal(row: np.ndarray, column: np.ndarray, value: np.ndarray, grade: np.ndarray, width: int, weight: np.ndarray, ridge: float = 1e-5, rounds: int = 800, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ascending thresholds of most penalised weighted likelihood, by Adam on all rows."""
    n, cuts = len(grade), GRADES - 1
    # the thresholds are the first one and steps of positive size, so that they stay in order
    params = np.concatenate([np.zeros(width), [0.0], np.zeros(cuts - 1)])
    mean, square = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        w, gaps = params[:width], np.exp(params[width + 1 :])
        theta = params[width] + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(row, weights=value * w[column], minlength=n)
        above = np.hstack([np.ones((n, 1)), sigmoid(score[:, None] - theta), np.zeros((n, 1))])
        slope = above * (1 - above)
        at = np.arange(n)
        chance = np.maximum(above[at, grade] - above[at, grade + 1], 1e-12)
        lower, upper = slope[at, grade] / chance * weight, slope[at, grade + 1] / chance * weight
        by_score = upper - lower  # of the negative log likelihood
        by_theta = np.zeros(cuts + 2)
        np.add.at(by_theta, grade, lower)
        np.add.at(by_theta, grade + 1, -upper)
        by_theta = by_theta[1:-1]
        tail = np.cumsum(by_theta[::-1])[::-1]
        grad = np.concatenate([np.bincount(column, weights=value * by_score[row], minlength=width) + ridge * w, [tail[0]], tail[1:] * gaps])
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        params = params - rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    gaps = np.exp(params[width + 1 :])
    return params[:width], params[width] + np.concatenate([[0.0], np.cumsum(gaps)])


def with_severity(docs: DataFrame, model: Model) -> DataFrame:
    """Adds p_toxic (chance of a grade above 0), severity (expected grade), grade (likeliest) and toxic."""

    @F.pandas_udf("p_toxic double, severity double, grade int")
    def judge(texts: pd.Series) -> pd.DataFrame:
        texts = texts.tolist()
        parts = []
        for a, b in chunks(texts):
            parts.append(model.grades(*sparse(texts[a:b], model.features), b - a))
        chance = np.concatenate(parts) if parts else np.zeros((0, GRADES))
        return pd.DataFrame({"p_toxic": 1 - chance[:, 0], "severity": chance @ np.arange(GRADES), "grade": chance.argmax(1).astype(np.int32)})

    added = ("_judged", "p_toxic", "severity", "grade", "toxic")
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in added]
    judged = docs.withColumn("_judged", judge(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return judged.select(*others, "_judged.p_toxic", "_judged.severity", "_judged.grade", (F.col("_judged.p_toxic") >= REJECT_FROM).alias("toxic"))
