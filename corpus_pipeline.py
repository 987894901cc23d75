"""From documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, works on whole texts of all of it,
and hands on the columns of ``documents``; the last one returns the pieces of
the packed sequences. Stages are written as Parquet below the shared checkpoint
folder and read again, so that a lost executor never costs more than a stage's
running tasks.

1. toxicity: documents that the ordinal regression puts above grade 0 go.
2. quality: documents that the network scores below 0.5 go.
3. near duplicates: of each group of rows that similar shingle sets connect, one
   stays: that of the smallest id (rows without an id come last). Rows are told
   apart by a key of their own, so that different texts under one id are
   documents of their own. Rows without words are in no group and stay.
4. personal data: spans are replaced by their kind in brackets; n_chars follows.
5. packing: best-fit packing into sequences of 2048 tokens.

Classifiers are fitted on the labelled documents that reach their stage; where
those are of one class or none, the stage keeps all documents. Empty
tables pass through all stages, and columns beyond those of ``documents`` stay
up to the last one.

SQL can't express the classifiers; tests hold the stages against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martlake.llm import jaccard_join, packing, pii, quality, toxicity
from martlake.llm.common import small_arrow_batches, stored
from martlake.llm.queries import BYTE_BPE, table


def _rows(docs: DataFrame) -> DataFrame:
    """The documents as ``_row`` beside their text, so that no column clashes with those that a stage adds."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    if not model.both_classes:
        return docs
    return toxicity.with_severity(_rows(docs), model).filter(~F.col("toxic")).select("_row.*")


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    if not model.both_classes:
        return docs
    return quality.with_score(_rows(docs), model).filter("predicted = 1").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_arrow_batches(spark)
    # stored, as the keys must be the same in all reads
    keyed = stored(_rows(docs).select("_row", F.monotonically_increasing_id().alias("_key")), "rows")
    groups = jaccard_join.with_components(keyed.select(F.col("_key").alias("doc_id"), F.col("_row.text").alias("text")))
    ids = keyed.select("_key", F.col("_row.doc_id").alias("id"))
    order = F.struct(F.col("id").isNull(), "id", "_key")
    heads = groups.join(ids, groups["doc_id"] == ids["_key"]).groupBy("component_id").agg(F.min_by("_key", order).alias("_key"))
    return keyed.join(heads.select("_key"), "_key", "left_semi").select("_row.*")


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_arrow_batches(spark)
    found = stored(pii.with_candidates(docs.select("text"), "_found").select("_found"), "pii")
    model = pii.fit(found, "_found")
    spans = pii.with_spans(pii.with_candidates(_rows(docs), "_found"), model, "_found", "_spans")
    redacted = spans.select("_row", "_spans", F.when(F.col("text").isNotNull(), pii.redacted(F.col("text"), F.col("_spans"))).alias("_redacted"))
    columns = {c: F.col(f"_row.`{c}`") for c in docs.columns} | {"text": F.col("_redacted")}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.size("_spans") > 0, F.char_length("_redacted").cast("long")).otherwise(columns["n_chars"])
    return redacted.select(*[value.alias(c) for c, value in columns.items()])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_arrow_batches(spark)
    return packing.pack(packing.pieces(docs, BYTE_BPE))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
