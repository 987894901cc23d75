"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import text_or_empty


def _labels(docs: DataFrame, labels: DataFrame, label: str, eligible: Column | None) -> DataFrame:
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
    if eligible is not None:
        rows = rows.filter(eligible)
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    return rows.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")  # ids only, no texts


def label_counts(docs: DataFrame, labels: DataFrame, label: str, eligible: Column | None = None) -> DataFrame:
    """label and the number n of labelled documents, as ``sample`` counts them."""
    return _labels(docs, labels, label, eligible).groupBy("label").agg(F.count("*").alias("n"))


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, eligible: Column | None = None) -> DataFrame:
    """Texts of at most ``per_class`` labelled documents of each class, as (doc_id, text, label).

    Which ones is fixed by a hash of the id, so that every run fits the same
    rows. A document labelled twice counts by its larger label; rows without id
    or label, and labels without a document, are left out before the bound. The
    chosen ids, at most ``2 * per_class``, are broadcast; of rows that repeat an id
    the one with the least hash of its text is taken, so that what reaches the
    driver is bounded however often an id repeats.
    """
    rows = _labels(docs, labels, label, eligible)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = rows.filter("label = 0").orderBy(*order).limit(per_class).unionByName(rows.filter("label = 1").orderBy(*order).limit(per_class))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    own = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label")
    return own.agg(F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")).select("doc_id", "text", "label")
