"""The registered queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.llm import curves, exact_topk, filter_audit, html_text, jaccard_join, packing, periodic_runs, pii, quality, sentencepiece_bpe, token_counts, toxicity, warc
from martlake.llm.common import scratch_path, small_arrow_batches, stored

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_arrow_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write(warc.with_record_types(table(spark, sf_dir, "pages")), path)
    return warc.valid(warc.read(spark, path, with_payload=False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.with_severity(docs, model).select("doc_id", "p_toxic", "severity", "grade", "toxic")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.with_components(table(spark, sf_dir, "documents"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = stored(pii.with_candidates(docs).drop("text"), "pii")
    return pii.with_spans(found, pii.fit(found)).select("doc_id", *pii.digests())


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_bpe.digests(table(spark, sf_dir, "documents").select("doc_id", "text"), PIECE_BPE).drop("text")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), BYTE_BPE))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.with_score(docs, model).select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own, empty at first: the query's work doesn't depend on earlier ones
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, PIECE_BPE, scratch_path(spark, "token-cache"))
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(filter_audit.mask_counts(failed, table(spark, sf_dir, "labels")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_warc": op1_warc,
    "op2_toxicity": op2_toxicity,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_pii": op4_pii,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_exact_topk": op6_exact_topk,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_html_text": op8_html_text,
    "op9_quality": op9_quality,
    "op10_curve_neighbours": op10_curve_neighbours,
    "op11_token_counts": op11_token_counts,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL: dict[str, str] = {
    # the same whole-number products, for all pairs; rows with one id count once, by the least vector
    "op6_exact_topk": """
WITH e AS (
  SELECT vec_id, min(embedding) AS embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM e),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    # every order applied to counts by part and failed filters
    "op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS words, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
f AS (
  SELECT doc_id, part, len(words) < 200 AS a, 100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d, coalesce(first_id < doc_id, false) AS e
  FROM w),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
m AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
         count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT x1.x || x2.x || x3.x || x4.x || x5.x AS filter_order, [x1.bit, x2.bit, x3.bit, x4.bit, x5.bit] AS bits
  FROM x x1, x x2, x x3, x x4, x x5
  WHERE x1.bit + x2.bit + x3.bit + x4.bit + x5.bit = 31 AND (x1.bit | x2.bit | x3.bit | x4.bit | x5.bit) = 31),
s AS (
  SELECT filter_order, CAST(step AS INTEGER) AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN bad ELSE 0 END)::BIGINT AS toxic_lost
  FROM m, s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r""",
}
