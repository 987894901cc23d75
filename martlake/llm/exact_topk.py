"""Exact top-k inner products: vectors by falling length, pruned by Cauchy-Schwarz.

Vectors become integers (floor(64 x)), are ranked by falling length and cut
into blocks. Each query first searches the block of the longest vectors; its
k-th score there bounds what can still matter. A block whose longest vector
times the query's length stays below that bound is not visited. Inside a block
both sides are rotated by the singular vectors of the whole table, so that a
partial sum over the leading dimensions holds most of a product; the rest is at
most the product of the lengths of what is left. Pairs whose partial sum and
rest stay below the bound are ruled out, all others get their exact score.

Defined results: rows without id, vector or finite components take no part;
rows with one id count once, by the least vector; shorter vectors count as
ending in zeros; equal scores go by smaller id; fewer than k candidates give
fewer rows; other columns are not read. Scores are exact while squared lengths
stay below 2**52; beyond that the products are taken in whole numbers of any
size, and a score that is no long fails the job.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm import vectors
from martlake.llm.common import ranked, stored

SCALE = 64
LEADING = 16  # dimensions of the partial sums
EXACT = 2.0**52


def scaled(vector: Column) -> Column:
    """Components as whole numbers, kept as doubles."""
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x).cast("double"))


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers."""
    if (q**2).sum(1).max() < EXACT and (c**2).sum(1).max() < EXACT:
        return q @ c.T
    return (np.array([[int(x) for x in r] for r in q], object) @ np.array([[int(x) for x in r] for r in c], object).T)


def pruned(rotation: np.ndarray):
    """Scores with the pairs that Cauchy-Schwarz can't rule out."""

    def score(q: np.ndarray, c: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = q.shape[1]
        turn = rotation[:width, :LEADING]
        lead_q, lead_c = q @ turn, c @ turn
        rest_q = np.sqrt(np.maximum((q**2).sum(1) - (lead_q**2).sum(1), 0))
        rest_c = np.sqrt(np.maximum((c**2).sum(1) - (lead_c**2).sum(1), 0))
        length = np.outer(np.sqrt((q**2).sum(1)), np.sqrt((c**2).sum(1)))
        most = lead_q @ lead_c.T + np.outer(rest_q, rest_c) + 1e-7 * length + 1e-6  # with room for rounding
        allowed = most >= bound[:, None]
        if allowed.mean() > 0.1:
            return products(q, c), allowed
        row, column = np.nonzero(allowed)
        scores = np.full(allowed.shape, -np.inf)
        if (q**2).sum(1).max(initial=0) < EXACT and (c**2).sum(1).max(initial=0) < EXACT:
            scores[row, column] = np.einsum("ij,ij->i", q[row], c[column])
            return scores, allowed
        return products(q, c), allowed

    return score


def top_k(table: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k best rows of each query row."""
    rows = vectors.valid(table, F.transform(vector, lambda x: x.cast("double"))).withColumn("vec", scaled(F.col("vec")))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))
    rows = ranked(rows.withColumn("length", length), [F.col("length").desc(), F.col("vec_id")], "topk").withColumn("block", F.floor(F.col("rank") / vectors.BLOCK))
    blocks = rows.groupBy("block").agg(F.max("length").alias("longest"), F.max(F.size("vec")).alias("width")).orderBy("block").collect()  # a row for each block
    if not blocks:
        return _ranked_rows(table.sparkSession.createDataFrame([], "query_id long, vec_id long, score long"), k)
    width = max(b["width"] for b in blocks)
    rotation = np.linalg.svd(vectors.second_moments(rows, width))[0]
    own = vectors.in_parts(rows.filter(is_query).select("rank", "vec_id", "vec", "length"), ["rank"], "topk-queries")

    first = vectors.search(own.withColumns({"block": F.lit(0).cast("long"), "bound": F.lit(float("-inf"))}), rows.filter("block = 0"), pruned(rotation), k, "long")
    first = stored(first, "topk-first")
    bounds = first.groupBy(F.col("query_id").alias("bound_id")).agg(F.min("score").alias("least"), F.count("*").alias("found"))
    bound = F.when(F.col("found") >= k, F.col("least").cast("double")).otherwise(F.lit(float("-inf")))
    bounded = own.join(bounds, F.col("vec_id") == F.col("bound_id"), "left").withColumn("bound", F.coalesce(bound, F.lit(float("-inf"))))
    longest = np.array([b["longest"] for b in blocks])

    def visits(batches):
        for batch in batches:
            most = np.outer(batch["length"], longest) * (1 + 1e-9) + 1e-6
            count = (most >= batch["bound"].to_numpy()[:, None]).sum(1)  # the blocks are in falling order
            out = batch.loc[batch.index.repeat(np.maximum(count - 1, 0))]
            yield out.assign(block=np.concatenate([np.arange(1, max(n, 1)) for n in count]) if len(out) else pd.Series([], dtype="int64"))[["block", "part", "vec_id", "vec", "bound"]]

    rest = bounded.select("part", "vec_id", "vec", "length", "bound").mapInPandas(visits, "block long, part long, vec_id long, vec array<double>, bound double")
    found = vectors.search(rest, rows.filter("block > 0"), pruned(rotation), k, "long")
    return _ranked_rows(first.unionByName(found), k)


def _ranked_rows(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    out = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")
