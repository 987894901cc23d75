"""Runs of repeating words, found with string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends with period q, of at least ``EXPONENT``
periods and ``SHORTEST`` words. All runs of whole texts are found exactly:

* Periods 1 to 3 come from comparing each word with the word q places on.
* Longer periods come from dyadic scales t = 4, 8, 16, ...; scale t proposes
  the periods t to 2t - 1. Windows of t words get names by doubling (equal
  names for equal windows, no hashing). Place i is selected when the least
  hash among the windows beginning at i to i + t is that of its own first or
  last one. So the choice depends on words i to i + 2t - 1 alone, and of t
  neighbouring places at least one is selected.
* Windows inside known runs of periods up to t / 4 take no part in the choice,
  so that highly periodic stretches don't fill it. The runs that they belong
  to are those of smaller scales, which are complete by then.
* Selected places with equal contexts of 2t words, next to one another, propose
  their distance as a period. A run of period q in t to 2t - 1 and of at least
  four periods holds a selected place in its first t words and, by consistency,
  another one q words on; nothing nearer has that context, as the run would
  have a smaller period. Each proposal is extended word by word to its run.

Texts whose windows don't repeat leave after few scales. Work is in proportion
to words times scales, and everything is done within a text: no shuffle.

Defined results: null and empty texts have no runs and collapse to an empty
text; rows are independent of each other, so that repeated rows give repeated
results; other columns pass through unless they clash with the added ones,
which win; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import text_or_empty
from martlake.llm.flat import mix, small_batches

EXPONENT, SHORTEST = 4, 6
DIRECT = 3  # periods that are found by comparing words
SLICE = 1 << 20  # bytes of text handled at once; one longer text is a slice of its own
NEVER = np.uint64(2**64 - 1)  # after every hash of a window's name

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Equal numbers for equal pairs."""
    return pd.factorize(left * (int(right.max(initial=0)) + 1) + right)[0]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours."""
    n = len(x) - width + 1
    blocks = np.full(-(-len(x) // width) * width, NEVER)
    blocks[: len(x)] = x
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _agreement(words: np.ndarray, x: int, y: int, step: int) -> int:
    """How many words agree from places x and y > x on, going by ``step`` (1 or -1)."""
    total, block = 0, 64
    while True:
        if step > 0:
            a, b = words[x + total : x + total + block], words[y + total : y + total + block]
            a = a[: len(b)]
        else:
            to = x - total + 1
            a, b = words[max(0, to - block) : to][::-1], words[max(0, to - block) + y - x : to + y - x][::-1]
        off = np.flatnonzero(a != b)
        if len(off):
            return total + int(off[0])
        total += len(a)
        if len(a) < block:
            return total
        block *= 2


class _Words:
    """The words of the texts that may still have runs, each text followed by a word of its own kind.

    ``words`` differ between texts, so that nothing reaches across; ``text`` and
    ``place`` say what each stands for.
    """

    def __init__(self, words: np.ndarray, bounds: np.ndarray) -> None:
        lengths = np.diff(bounds)
        texts = np.arange(len(lengths))
        ends = bounds[1:] + texts  # places of the closing words
        self.words = np.empty(len(words) + len(texts), np.int64)
        closing = np.zeros(len(self.words), bool)
        closing[ends] = True
        self.words[~closing] = words
        self.words[closing] = int(words.max(initial=-1)) + 1 + texts
        self.text = np.repeat(texts, lengths + 1)
        self.place = np.arange(len(self.words)) - (bounds[:-1] + texts)[self.text]
        self.lengths = lengths

    def keep(self, alive: np.ndarray, names: np.ndarray, size: int) -> np.ndarray:
        """Only the texts marked in ``alive``; ``names`` of windows of ``size`` words follow."""
        stay = alive[self.text]
        if not stay.all():
            names = names[stay[: len(names)]]
            self.words, self.text, self.place = self.words[stay], self.text[stay], self.place[stay]
        return names[: max(0, len(self.words) - size + 1)]

    def repeating(self, names: np.ndarray, shortest: int) -> np.ndarray:
        """Texts of at least ``shortest`` words with two equal windows."""
        alive = np.zeros(len(self.lengths), bool)
        alive[self.text[: len(names)][np.bincount(names)[names] > 1]] = True
        return alive & (self.lengths >= shortest)

    def starts(self) -> np.ndarray:
        """Where each text begins; -1 where it is gone."""
        out = np.full(len(self.lengths), -1, np.int64)
        first = np.flatnonzero(self.place == 0)
        out[self.text[first]] = first
        return out


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edges[::2], edges[1::2]


def _direct(at: _Words) -> np.ndarray:
    """Runs of periods up to DIRECT, as rows (text, start, length, period)."""
    found, seen = [], np.zeros(0, np.int64)
    for q in range(1, DIRECT + 1):
        begin, end = _stretches(at.words[:-q] == at.words[q:])
        full = end - begin >= (EXPONENT - 1) * q
        begin, end = begin[full], end[full] + q
        extent = begin * (len(at.words) + 1) + end
        new = ~np.isin(extent, seen)  # the same stretch has a smaller period otherwise
        seen = np.concatenate([seen, extent[new]])
        begin, end = begin[new], end[new]
        found.append(np.column_stack([at.text[begin], at.place[begin], end - begin, np.full(len(begin), q)]))
    return np.concatenate(found)


def _selected(names: np.ndarray, size: int, periodic: np.ndarray) -> np.ndarray:
    """The synchronising set at a scale: places whose windows win among their neighbours."""
    order = mix(names.astype(np.uint64))
    order[periodic] = NEVER
    least = _sliding_min(order, size + 1)
    return np.flatnonzero((least != NEVER) & ((least == order[: len(least)]) | (least == order[size:])))


def _periodic(at: _Words, found: np.ndarray, size: int, windows: int) -> np.ndarray:
    """Windows of ``size`` words that lie in known runs of periods up to a quarter of it."""
    base = at.starts()[found[:, 0]]
    small = (found[:, 3] * 4 <= size) & (found[:, 2] >= size) & (base >= 0)
    first = base[small] + found[small, 1]
    marks = np.zeros(windows + 1, np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, first + found[small, 2] - size + 1, -1)
    return np.cumsum(marks[:-1]) > 0


def _proposed(at: _Words, places: np.ndarray, contexts: np.ndarray, size: int) -> np.ndarray:
    """Runs that begin with neighbouring selected places of equal context, as rows (text, start, length, period)."""
    order = np.argsort(contexts[places], kind="stable")
    a, b = places[order[:-1]], places[order[1:]]
    q = b - a
    ok = (contexts[a] == contexts[b]) & (q >= size) & (q < 2 * size)
    a, q = a[ok], q[ok]
    order = np.lexsort([a, q])
    found, last, end = [], -1, -1
    for x, period in zip(a[order].tolist(), q[order].tolist(), strict=True):
        if period == last and x + period < end:
            continue  # in the run found before
        back = _agreement(at.words, x - 1, x - 1 + period, -1) if x else 0
        last, end = period, x + period + _agreement(at.words, x, x + period, 1)
        if end - (x - back) >= EXPONENT * period:
            found.append((at.text[x], at.place[x] - back, end - (x - back), period))
    return np.array(found, np.int64).reshape(-1, 4)


def find_runs(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All runs as rows (text, start, length, period), in that order.

    ``words[bounds[t]:bounds[t + 1]]`` are the words of text t as numbers that
    no other text uses.
    """
    if not len(words):
        return np.zeros((0, 4), np.int64)
    at = _Words(np.asarray(words, np.int64), bounds)
    found = _direct(at)
    names, size = pd.factorize(at.words)[0], 1
    while True:
        # a scale needs windows of its own size and contexts of twice that size
        names = at.keep(at.repeating(names, EXPONENT * max(size, DIRECT + 1)), names, size)
        if not len(names):
            break
        contexts = _names(names[:-size], names[size:])
        if size > DIRECT:
            periodic = _periodic(at, found, size, len(names))
            found = np.concatenate([found, _proposed(at, _selected(names, size, periodic), contexts, size)])
        names, size = contexts, 2 * size
    found = found[found[:, 2] >= SHORTEST]
    return found[np.lexsort([found[:, 3], found[:, 1], found[:, 0]])]


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Words as numbers, other ones for each text, and where each text begins."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    out, used = np.empty(bounds[-1], np.int64), 0
    for words, begin, end in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        known: dict[bytes, int] = {}
        out[begin:end] = [known.setdefault(w, len(known)) for w in words]
        out[begin:end] += used
        used += len(known)
    return out, bounds


def _collapsed(texts: list[list[bytes]], bounds: np.ndarray, found: np.ndarray) -> list[bytes]:
    """Words that are in no run, or in each of theirs only among its first period."""
    marks = np.zeros(bounds[-1] + 1, np.int64)
    first = bounds[found[:, 0]] + found[:, 1]
    np.add.at(marks, first + found[:, 3], 1)
    np.add.at(marks, first + found[:, 2], -1)
    kept = np.cumsum(marks[:-1]) == 0
    with_runs = set(found[:, 0].tolist())
    out = []
    for t, words in enumerate(texts):
        if t in with_runs:
            words = [words[i] for i in np.flatnonzero(kept[bounds[t] : bounds[t + 1]])]
        out.append(b" ".join(words))
    return out


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    first = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > SLICE:
            yield first, i
            first, size = i, 0
        size += n
    if first < len(sizes):
        yield first, len(sizes)


def with_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``runs`` (start, length and period in words, by start and period) and ``collapsed``.

    ``collapsed`` holds the words that no run repeats, joined by one space: of
    each run the first period stays.
    """
    added = [T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())]
    others = [c for c in docs.columns if c.lower() not in {"runs", "collapsed", "_text"}]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], text_or_empty(text).cast("binary").alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], *added])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            column = batch.column(batch.num_columns - 1)
            sizes = [len(x.as_buffer()) for x in column]
            for a, b in _slices(sizes):
                texts = [x.split() for x in column.slice(a, b - a).to_pylist()]  # of bytes: at \x20 and \x09-\x0D
                words, bounds = _numbered(texts)
                found = find_runs(words, bounds)
                at = np.searchsorted(found[:, 0], np.arange(len(texts) + 1))
                fields = [pa.array(np.ascontiguousarray(found[:, i])) for i in (1, 2, 3)]
                runs = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"])).cast(kind)
                collapsed = pa.array(_collapsed(texts, bounds, found), pa.binary()).cast(pa.string())
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], runs, collapsed], schema.names)

    return rows.mapInArrow(run, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """``text`` with the repetition that the contract of the query plants in a tenth of the documents.

    With h the CRC-32 of the decimal id, g = h // 10 and n words: where h % 10
    is 0, word i from a = g % n on becomes word a + (i - a) % p, with
    p = 1 + (n - a) // (3 + g % 8). Texts without id or words stay as they are.
    """
    h = F.crc32(doc_id.cast("long").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[ \t-\r]+"), lambda w: w != "")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))

    # the words are bound to a variable of a lambda, so that they are split once for each text
    changed = F.get(F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w), " ")).otherwise(text)), F.lit(0))
    return F.when(h % 10 == 0, changed).otherwise(text)


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the number of runs, the longest one, and digests of all runs and of the collapsed text."""
    rows = docs.select("doc_id", planted(F.col("doc_id"), text_or_empty()).alias("text"))
    found = with_runs(rows)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("_longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("_longest.s")).alias("start"),
        F.col("_longest.l").alias("length"),
        (-F.col("_longest.p")).alias("period"),
        F.floor(1000 * F.col("_longest.l") / -F.col("_longest.p")).alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
