"""Vector tables in blocks of rank, and the search of query rows within blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ranked

BLOCK = 8192  # vectors of one block
SLICE = 512  # queries whose products with a block are held at once


def valid(table: DataFrame, vector: Column, nonzero: bool = False) -> DataFrame:
    """vec_id and the vector as doubles of the rows that take part.

    Null ids, null vectors and vectors with null or non-finite components are
    left out, zero vectors too if asked. Of rows with one id the least vector
    counts, so that repeated rows count once.
    """
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vec")).filter("vec_id is not null and vec is not null")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)))
    if nonzero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def in_parts(queries: DataFrame, keys: list, name: str) -> DataFrame:
    """``queries`` with ``part``, their own ranks by ``keys`` in blocks.

    Candidates are copied to each part that visits them: parts are as many as
    the queries need, however many other rows lie between them.
    """
    return ranked(queries, keys, name, "_place").withColumn("part", F.floor(F.col("_place") / BLOCK)).drop("_place")


def matrix(column, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    out = np.zeros((len(column), width))
    for i, row in enumerate(column):
        out[i, : len(row)] = row
    return out


def second_moments(rows: DataFrame, width: int) -> np.ndarray:
    """The sum of x x^T over all vectors; each task adds up its own before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            x = matrix(batch.column(0).to_pylist(), width)
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int64()), pa.array([r.tobytes() for r in total], pa.binary())], ["i", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[i] = total.get(i, 0) + np.frombuffer(sums)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["i", "sums"])

    out = np.zeros((width, width))
    for row in rows.select("vec").mapInArrow(count, "i long, sums binary").repartition("i").mapInArrow(add, "i long, sums binary").collect():
        out[row["i"]] = np.frombuffer(bytes(row["sums"]))  # one matrix of the vectors' width
    return out


def best(scores: np.ndarray, allowed: np.ndarray, query: np.ndarray, ids: np.ndarray, k: int, itself: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best allowed scores of each row; equal scores by smaller id; a query's own id only if asked."""
    if not itself:
        allowed &= query[:, None] != ids
    held = np.where(allowed, scores, -np.inf)
    if held.shape[1] > k:
        least = -np.partition(-held, k - 1, axis=1)[:, k - 1]
        allowed &= held >= least[:, None]
    row, column = np.nonzero(allowed)
    order = np.lexsort((ids[column], -scores[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row)
    top = np.arange(len(row)) - first < k
    return row[top], column[top]


def search(queries: DataFrame, candidates: DataFrame, score: Callable, k: int, kind: str, itself: bool = False) -> DataFrame:
    """The k best candidates of each query within each block that it visits.

    ``candidates`` have block, vec_id and vec; ``queries`` have block (one row
    for each block visited), part, vec_id, vec and bound. At most BLOCK queries
    share a part, so that a task holds two blocks at most; a block's candidates
    go to each part that visits it. ``score(q, c, bound)`` gives scores and
    the pairs that it could not rule out. ``itself`` lets a query find its own id.
    """
    # both sides may come from one table, so each gets columns of its own
    asked = queries.select(*[F.col(c).alias(f"q_{c}") for c in ("block", "part", "vec_id", "vec", "bound")])
    parts = queries.select(F.col("block").alias("p_block"), F.col("part").alias("p_part")).distinct()
    held = candidates.select(*[F.col(c).alias(f"c_{c}") for c in ("block", "vec_id", "vec")])
    spread = held.join(parts, F.col("c_block") == F.col("p_block")).drop("p_block")

    def run(key: tuple, q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        width = max(max(map(len, q["q_vec"])), max(map(len, c["c_vec"])))
        vecs, ids, out = matrix(c["c_vec"], width), c["c_vec_id"].to_numpy(), []
        for at in range(0, len(q), SLICE):
            some = q.iloc[at : at + SLICE]
            query = some["q_vec_id"].to_numpy()
            scores, allowed = score(matrix(some["q_vec"], width), vecs, some["q_bound"].to_numpy())
            row, column = best(scores, allowed, query, ids, k, itself)
            out.append(pd.DataFrame({"query_id": query[row], "vec_id": ids[column], "score": scores[row, column]}))
        return pd.concat(out).astype({"score": "int64" if kind == "long" else "float64"})

    return asked.groupBy("q_block", "q_part").cogroup(spread.groupBy("c_block", "p_part")).applyInPandas(run, f"query_id long, vec_id long, score {kind}")
