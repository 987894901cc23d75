"""Exact Jaccard join of word-shingle sets in regions around pivots.

Jaccard distance is a metric, so distances to a pivot bound distances to each
other. Texts of the invented or natural kind are nearly all at distance 1 from
each other, and a pivot tells nothing of documents that share nothing with it.
Regions are therefore formed where distances are below 1: documents that share
one of their rare shingles form a block, and the block's smallest document is
its pivot. Any two documents with a Jaccard similarity of at least 0.8 share one
of the first n - ceil(0.8 n) + 1 shingles of their sets in any common order
(rare shingles first here), so they meet in a block, and either one of them is
the pivot or both lie in the pivot's region. A document lies in the regions of
all pivots whose blocks it shares, which replicates documents at boundaries.

1. Equal sets become one class, so that copies cost one row each.
2. Blocks are formed by one sort of (shingle, document); the exact distance of
   each member to the pivot is taken once per pair. Members within the threshold
   are linked to it.
3. The pivot has met everybody and leaves. Members stay that meet another one
   which is not connected to them by now and whose size allows a link (sizes
   bound distances too: the triangle inequality against the empty set). They
   form blocks again, with new pivots: the join recurses.
4. After ROUNDS of this, what is left of a region is joined exactly. A region
   larger than TILE is cut by size and by hash, and all pairs of cells that may
   hold links meet. Inside a cell only the links that
   connect something are given out, at most one for each member.

All texts are read whole and no candidate is dropped. Only shingles that occur
in many documents come late in the order; which ones is a list of at most
FREQUENT entries, and the order affects the cost and not the result.

Defined results: texts without words have an empty set and are linked with
nothing; null ids take no part in links and have no component; rows that share
an id are one document with the links of each; repeated rows give repeated
result rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import stored, text_or_empty
from martlake.llm.components import components
from martlake.llm.flat import mix, small_batches
from martlake.llm.shingles import WIDTH, shingle_sets, signature

PERCENT = 80  # 100 * intersection >= PERCENT * union
FREQUENT, FREQUENT_FROM = 1 << 18, 32
ROUNDS = 2
TILE = 1024
SLICE = 1.26  # ratio of sizes within a slice; linked sizes differ by a factor of 100 / PERCENT at most
FILTER_BITS = 1 << 24  # of the bitmap that thins out texts before they are shuffled


def prefix_length(n: int) -> int:
    """How many leading shingles of a set of n must be looked at."""
    return n - -(-PERCENT * n // 100) + 1 if n else 0


def linked(shared, n, m):
    """Whether sets of n and m with that many shared shingles are similar enough."""
    return 100 * shared >= PERCENT * (n + m - shared)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in small_batches(batches):
        yield part, shingle_sets(part.column(part.num_columns - 1).to_pylist())


def frequent_shingles(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Upper hash halves of the most frequent leading shingles, sorted, and the log of their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _batches(batches):
            heads = [s[: prefix_length(len(s)) * 3 // 2 + 4] for s in sets if len(s)]
            if heads:
                keys, n = np.unique(np.concatenate(heads) >> np.uint64(32), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.uint32).view(np.int32)), pa.array(n.astype(np.int64))], ["s", "n"])

    counts = docs.select(text_or_empty().alias("text")).mapInArrow(count, "s int, n long").groupBy("s").agg(F.sum("n").alias("n"))
    top = counts.filter(F.col("n") >= FREQUENT_FROM).orderBy(F.col("n").desc(), "s").limit(FREQUENT).toPandas()  # a list of fixed size
    keys = top["s"].to_numpy(np.int32).view(np.uint32).astype(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log2(np.maximum(top["n"].to_numpy(float), 1))[order].astype(np.int64) + 1


def _leading(shingles: np.ndarray, keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the common order: by frequency level, then by hash."""
    n = prefix_length(len(shingles))

    def level(some: np.ndarray) -> np.ndarray:
        if not len(keys):
            return np.zeros(len(some), np.int64)
        half = some >> np.uint64(32)
        at = np.minimum(np.searchsorted(keys, half), len(keys) - 1)
        return np.where(keys[at] == half, levels[at], 0)

    head = shingles[: 2 * n + 8]
    rare = head[level(head) == 0]
    if len(rare) >= n:
        return rare[:n]
    return shingles[np.argsort(level(shingles), kind="stable")[:n]]


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and a signature of the set (two longs)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _batches(batches):
            signs = np.array([signature(s) for s in sets], np.int64).reshape(-1, 2)
            columns = [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(signs[:, 0]), pa.array(signs[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "sig_a", "sig_b"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, sig_a long, sig_b long")


def shingled(docs: DataFrame) -> DataFrame:
    """``signatures`` and the leading shingles of each set."""
    keys, levels = frequent_shingles(docs)
    sent = docs.sparkSession.sparkContext.broadcast((keys, levels))  # at most FREQUENT entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _batches(batches):
            signs = [signature(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s[0] for s in signs], pa.int64()),
                    pa.array([s[1] for s in signs], pa.int64()),
                    pa.array([_leading(s, *sent.value).view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["doc_id", "n_shingles", "sig_a", "sig_b", "leading"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, sig_a long, sig_b long, leading array<long>")


def blocks(postings: DataFrame) -> DataFrame:
    """From (s, x, n): s, the block's pivot p and its size, and each other member x with its size.

    Sorted rows stream by; the first of a block is the pivot, so that a block of
    any size needs no memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pivot = size = None
        for batch in batches:
            if not batch.num_rows:
                continue
            s, x, n = (batch.column(k).to_numpy() for k in range(3))
            new = np.append(s[0] != block, s[1:] != s[:-1])
            at = np.maximum.accumulate(np.where(new, np.arange(len(s)), -1))
            p, m = np.where(at >= 0, x[at], pivot if pivot is not None else 0), np.where(at >= 0, n[at], size if size is not None else 0)
            block, pivot, size = s[-1], p[-1], m[-1]
            rest = ~new & (x != p)
            yield pa.RecordBatch.from_arrays([pa.array(c[rest], pa.int64()) for c in (s, p, m, x, n)], ["s", "p", "n_p", "x", "n_x"])

    ordered = postings.select("s", "x", "n").repartition("s").sortWithinPartitions("s", "x")
    return ordered.mapInArrow(run, "s long, p long, n_p long, x long, n_x long")


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds all ids."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(FILTER_BITS // 8, np.uint8)
        for batch in batches:
            at = mix(batch.column(0).to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FILTER_BITS)
            np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
        parts = bits.reshape(-1, 4096)
        full = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array([parts[i].tobytes() for i in full], pa.binary())], ["part", "bits"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, bits in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, np.uint8(0)) | np.frombuffer(bits, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "bits"])

    bits = np.zeros((FILTER_BITS // 8 // 4096, 4096), np.uint8)
    for row in ids.mapInArrow(count, "part long, bits binary").repartition("part").mapInArrow(unite, "part long, bits binary").collect():
        bits[row["part"]] = np.frombuffer(bytes(row["bits"]), np.uint8)  # 2 MB in all
    return bits.ravel()


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(x, text) of the documents whose id is among ``ids`` (x), and of few others."""
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))

    @F.pandas_udf("boolean")
    def held(x: pd.Series) -> pd.Series:
        at = mix(x.to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FILTER_BITS)
        return pd.Series((bits.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool))

    rows = docs.select(F.col("doc_id").cast("long").alias("x"), text_or_empty().alias("text")).filter("x is not null")
    return rows.filter(held("x"))


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (p, x) that are linked, as (a, b)."""
    ids = pairs.select(F.col("x")).unionByName(pairs.select(F.col("p").alias("x"))).distinct()
    texts = texts_of(docs, ids)
    both = pairs.join(texts, "x").join(texts.select(F.col("x").alias("p"), F.col("text").alias("text_p")), "p").select("p", "x", "text_p", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None
        for part, sets in _batches(batches):
            keep = []
            for text, own in zip(part.column(2).to_pylist(), sets, strict=True):
                if text != last:  # members of a pivot follow each other
                    last, last_set = text, shingle_sets([text])[0]
                shared = len(np.intersect1d(own, last_set, assume_unique=True))
                keep.append(bool(linked(shared, len(own), len(last_set))))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def forest(sets: list[np.ndarray], ids: list[int], groups: list[int]) -> list[tuple[int, int]]:
    """Links among sets that connect what ``groups`` leaves apart; no more than sets."""
    parent = {g: g for g in groups}

    def root(g: int) -> int:
        while parent[g] != g:
            parent[g] = parent[parent[g]]
            g = parent[g]
        return g

    sizes = np.array([len(s) for s in sets])
    if not sizes.sum():
        return []
    bounds = np.zeros(len(sets) + 1, np.int64)
    np.cumsum(sizes, out=bounds[1:])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, at = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(at, kind="stable")
    holders, starts = owner[order], np.searchsorted(at[order], np.arange(at.max() + 2))
    out = []
    for i in range(len(sets)):
        held = at[bounds[i] : bounds[i + 1]]
        counts = starts[held + 1] - starts[held]
        if counts.sum() == len(held):
            continue
        index = np.repeat(starts[held] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        shared = np.bincount(holders[index], minlength=len(sets))
        for j in np.flatnonzero(linked(shared, sizes[i], sizes) & (shared > 0) & (np.arange(len(sets)) > i)).tolist():
            a, b = root(groups[i]), root(groups[j])
            if a != b:
                parent[a] = b
                out.append((ids[i], ids[j]))
    return out


def _slice(n: str) -> F.Column:
    """Sizes of sets that may be linked are in one slice or in two that follow each other."""
    return F.floor(F.log(F.col(n).cast("double")) / F.log(F.lit(SLICE)))


def _open(grouped: DataFrame) -> DataFrame:
    """The members of blocks that meet a member of another group and of a size that may be linked."""
    rows = grouped.withColumn("slice", _slice("n_x"))
    near = F.explode(F.array(*[F.col("slice") + d for d in (-1, 0, 1)]))
    meets = rows.select("s", near.alias("slice"), "group").groupBy("s", "slice").agg(F.min("group").alias("g1"), F.max("group").alias("g2"))
    return rows.join(meets.filter("g1 <> g2").select("s", "slice"), ["s", "slice"], "left_semi").drop("slice")


def _region_links(docs: DataFrame, regions: DataFrame) -> DataFrame:
    """Links that connect groups inside regions, from (p, x, n, group)."""
    counts = regions.groupBy("p").agg(F.count("*").alias("m"), F.min("group").alias("g1"), F.max("group").alias("g2"))
    cells = regions.join(counts.filter("m > 1 and g1 <> g2"), "p").withColumn("tiles", F.ceil(F.col("m") / TILE))
    cells = cells.withColumn("slice", F.when(F.col("tiles") > 1, _slice("n")).otherwise(0))
    cells = cells.withColumn("tile", F.pmod(F.xxhash64("x"), F.col("tiles")))
    others = F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)

    def cell(kind: int):
        own, low = F.col("tile"), F.col("slice")
        if kind == 0:
            return lambda j: F.struct(low.alias("slice"), F.lit(0).alias("kind"), F.least(own, j).alias("i"), F.greatest(own, j).alias("j"))
        if kind == 1:
            return lambda j: F.struct(low.alias("slice"), F.lit(1).alias("kind"), own.alias("i"), j.alias("j"))
        return lambda j: F.struct((low - 1).alias("slice"), F.lit(1).alias("kind"), j.alias("i"), own.alias("j"))

    same = F.transform(others, cell(0))
    meets = F.when(F.col("tiles") > 1, F.concat(same, F.transform(others, cell(1)), F.transform(others, cell(2)))).otherwise(same)
    rows = cells.withColumn("cell", F.explode(meets)).select("p", "cell", "x", "group")
    rows = rows.join(texts_of(docs, regions.select("x").distinct()), "x")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if group["group"].nunique() < 2:
            return pd.DataFrame({"a": [], "b": []})
        links = forest(shingle_sets(group["text"].tolist()), group["x"].tolist(), group["group"].tolist())
        return pd.DataFrame(links, columns=["a", "b"])

    return rows.groupBy("p", "cell").applyInPandas(run, "a long, b long")


def join(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_shingles, class: smallest id with an equal set) and links (a, b) between classes.

    The links connect exactly what the similar pairs connect.
    """
    # shingling twice takes less than keeping the leading shingles of all documents
    sets = stored(signatures(docs), "shingles")
    same = ["n_shingles", "sig_a", "sig_b"]
    usable = shingled(docs).filter("n_shingles > 0 and doc_id is not null")
    classes = usable.groupBy(*same).agg(F.min("doc_id").alias("class"), F.min_by("leading", "doc_id").alias("leading"))
    postings = classes.select(F.explode("leading").alias("s"), F.col("class").alias("x"), F.col("n_shingles").alias("n"))
    found = None
    left = stored(blocks(postings), "blocks")
    for last in range(ROUNDS):
        fits = 100 * F.least("n_p", "n_x") >= PERCENT * F.greatest("n_p", "n_x")
        links = stored(verified(docs, left.filter(fits).select("p", "x").distinct()), "links")
        found = links if found is None else found.unionByName(links)
        groups = stored(components(found), "groups")
        grouped = left.join(groups, left["x"] == groups["node"], "left").withColumn("group", F.coalesce("component", "x")).drop("node", "component")
        grouped = stored(_open(grouped), "open")
        if last < ROUNDS - 1:
            left = stored(blocks(grouped.select("s", "x", F.col("n_x").alias("n"))), "blocks")
    regions = grouped.select("p", "x", F.col("n_x").alias("n"), "group").distinct()
    found = found.unionByName(stored(_region_links(docs, regions), "links"))
    heads = classes.select(*same, "class")
    members = sets.select("doc_id", *same).join(heads, same, "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("class")).alias("class"))
    return members, found


def with_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id that links reach) of all documents."""
    members, links = join(docs)
    # rows that share an id connect the classes of their texts
    texts = members.filter("class is not null").groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("z")).filter("a <> z").select("doc_id", "a")
    several = members.join(texts, "doc_id").select("a", F.col("class").alias("b"))
    groups = components(links.unionByName(several))
    out = members.join(groups, members["class"] == groups["node"], "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "class", "doc_id").alias("component_id"))
