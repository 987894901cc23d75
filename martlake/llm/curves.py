"""Approximate nearest neighbours along shifted Hilbert curves.

Vectors of length one are projected on a few random orthogonal directions,
fitted to the range that the projections of all rows have, shifted, and ordered
by their place on a Hilbert curve; several curves with other directions and
shifts give several orders. Spark range-partitions each order and ranks it;
ranks are cut into blocks. A query meets the vectors of its own block and of
the blocks around it, on each curve; what the curves find is merged and
reranked by the exact inner product.

The curves bring together what points the same way. Large inner products also
come from long vectors that point less so: one more order is that by falling
length, and every query meets its first blocks. Equal places on a curve go by
falling length too.

Equal vectors are one vector on the curves, with the k + 1 smallest of its ids,
which are all that can be among the k best of any query: a group of copies may
hold any part of the rows.

Window: ``share`` is the part of the ranks that a query's window covers on one
curve. Vectors without structure need a wide one, whatever the method; a table
with clusters does with less. Recall against brute force is in the README.

Defined results: rows without id or vector, zero vectors and vectors with null
or non-finite components take no part; rows with one id count once, by the
least vector; shorter vectors count as ending in zeros; equal scores go by
smaller id; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlake.llm import vectors
from martlake.llm.common import ranked, stored
from martlake.llm.exact_topk import _ranked_rows
from martlake.operators.joins import salted_lookup_join

CURVES, DIMENSIONS, BITS, SHARE = 4, 3, 20, 0.4


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells with ``bits`` bits in each dimension.

    Undoes the curve's turns from the top bit down, then its Gray code.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            turned = (x[:, d] >> bit & 1).astype(bool)
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] = np.where(turned, x[:, 0] ^ low, x[:, 0] ^ swap)
            x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | x[:, d] >> bit & 1
    return key


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, vector: str = "embedding", curves: int = CURVES, share: float = SHARE, dimensions: int = DIMENSIONS
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest rows found for each query row."""
    table_rows = vectors.valid(table, F.transform(vector, lambda x: x.cast("double")), nonzero=True)
    table_rows = stored(table_rows.withColumn("vec", _trimmed(F.col("vec"))), "curves")
    rows = stored(_distinct(table_rows, k + 1), "curve-vectors")
    # the distinct vector of each query; a vector with many copies is looked up in several tasks
    queries, heads = table_rows.filter(is_query), rows.select(_digest().alias("same"), F.col("vec_id").alias("head"))
    asked = salted_lookup_join(queries.select(F.col("vec_id").alias("query_id"), _digest().alias("same")), heads, "same", "inner")
    asked = stored(asked.select("query_id", "head"), "curve-queries")
    stats = rows.agg(F.max(F.size("vec")).alias("width"), F.count("*").alias("n")).first()
    if not stats["n"]:
        return _ranked_rows(table.sparkSession.createDataFrame([], "query_id long, vec_id long, score double"), k)
    width = stats["width"]
    rng = np.random.default_rng(11)
    dimensions = min(dimensions, width)
    bits = min(BITS, 62 // dimensions)
    turn = np.hstack([np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dimensions] for _ in range(curves)])
    shifts = rng.uniform(0, 0.2, curves * dimensions)

    def axes(column: pd.Series) -> tuple[np.ndarray, np.ndarray]:
        """Lengths, and the projections of the vectors made as long as one."""
        x = vectors.matrix(column, width)
        most = np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
        length = np.linalg.norm(x / most, axis=1, keepdims=True)
        return (most * length)[:, 0], (x / most / length) @ turn

    def extent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        low, high = np.full(turn.shape[1], np.inf), np.full(turn.shape[1], -np.inf)
        for batch in batches:
            if len(batch):
                place = axes(batch["vec"])[1]
                low, high = np.minimum(low, place.min(0)), np.maximum(high, place.max(0))
        yield pd.DataFrame({"axis": np.arange(len(low)), "low": low, "high": high})

    ends = rows.select("vec").mapInPandas(extent, "axis int, low double, high double").groupBy("axis").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ends = sorted(tuple(r) for r in ends.collect())  # a row for each axis
    low = np.array([e[1] for e in ends])
    span = np.maximum(np.array([e[2] for e in ends]) - low, 1e-300)

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            length, place = axes(batch["vec"])
            # rounding may differ between batches, so a place may lie just outside
            cells = (np.clip((place - low) / span, 0, 1) * 0.8 + shifts) * ((1 << bits) - 1)
            cells = cells.astype(np.int64).reshape(len(batch), curves, dimensions)
            for curve in range(curves + 1):  # the last order is by length alone
                key = hilbert(cells[:, curve], bits) if curve < curves else 0
                yield pd.DataFrame({"curve": curve, "key": key, "length": length, "vec_id": batch["vec_id"]})

    blocks = -(-stats["n"] // vectors.BLOCK)
    reach = max(1, round(share * blocks / 2))
    places = ranked(rows.select("vec_id", "vec").mapInPandas(keys, "curve int, key long, length double, vec_id long"), ["curve", "key", F.col("length").desc(), "vec_id"], "curve-ranks")
    block = F.floor((F.col("rank") - F.col("curve") * stats["n"]) / vectors.BLOCK)
    places = places.select("vec_id", "curve", "rank", block.alias("at"))
    placed = stored(rows.select("vec_id", "vec").join(places, "vec_id"), "curve-blocks")

    step = F.lit(2 * blocks)  # sets the curves apart
    candidates = placed.select((F.col("curve") * step + F.col("at")).alias("block"), "vec_id", "vec")
    near = F.sequence(F.greatest(F.col("at") - reach, F.lit(0)), F.least(F.col("at") + reach, F.lit(blocks - 1)))
    longest = F.sequence(F.lit(0).cast("long"), F.lit(min(reach, blocks) - 1).cast("long"))
    heads = placed.join(asked.select(F.col("head").alias("vec_id")).distinct(), "vec_id", "left_semi")
    visits = vectors.in_parts(heads, ["rank"], "curve-parts").withColumn("visited", F.explode(F.when(F.col("curve") < curves, near).otherwise(longest)))
    queries = visits.select((F.col("curve") * step + F.col("visited")).alias("block"), "part", "vec_id", "vec", F.lit(0.0).alias("bound"))
    found = vectors.search(queries, candidates, _all_products, k + 1, "double", itself=True)
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    found = stored(_ranked_rows(found, k + 1).drop("rank"), "curve-found")

    # back to rows: the ids of the vectors found, and from those the best of each query that has the vector
    found = salted_lookup_join(found, rows.filter(F.size("ids") > 1).select("vec_id", "ids"), "vec_id", "left")
    found = found.select("query_id", "score", F.explode(F.coalesce("ids", F.array("vec_id"))).alias("vec_id"))
    best = _ranked_rows(found, k + 1).groupBy(F.col("query_id").alias("head")).agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("best"))
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = salted_lookup_join(asked, best, "head", "inner").select("query_id", F.posexplode(others).alias("at", "found"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), "found.vec_id", "found.score")


def _trimmed(vec: Column) -> Column:
    """A nonzero vector without zeros at its end and signs of zeros, so that equal vectors are equal arrays."""
    last = F.array_position(F.transform(F.reverse(vec), lambda x: x != 0), True)
    return F.transform(F.slice(vec, 1, (F.size(vec) - last + 1).cast("int")), lambda x: x + F.lit(0.0))


def _digest() -> Column:
    """One short key for each vector: hot vectors are told to all tasks of a join."""
    return F.sha2(F.array_join(F.transform("vec", lambda x: x.cast("string")), ","), 256)


def _distinct(rows: DataFrame, n: int) -> DataFrame:
    """Each vector once: its smallest id as vec_id, its ``n`` smallest as ids."""
    least = Window.partitionBy("vec").orderBy("vec_id")  # tasks drop what lies beyond before the shuffle
    few = rows.withColumn("_n", F.row_number().over(least)).filter(F.col("_n") <= n)
    ids = few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    return ids.select(F.col("ids")[0].alias("vec_id"), "ids", "vec")


def _all_products(q: np.ndarray, c: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return q @ c.T, np.ones((len(q), len(c)), bool)
