"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bulk-synchronous best-fit decreasing. Documents are range-sorted by falling
length, which makes the documents of one length a run of ranks. Gaps are kept
as runs too: intervals of sequences with equal free space. A sweep matches the
next run of documents with its successor, the run of the smallest gaps that
hold it; the r-th document of the run goes to the r-th gap, so two documents
never claim one place. The gaps used are updated, which returns them to the
sweep as smaller gaps; when no gap is left for a run, new sequences open.

Documents of one length are interchangeable, so a sweep needs the number of
documents of each length only: at most ``capacity`` numbers, whatever the size
of the corpus. The plan that it returns maps intervals of ranks to intervals of
sequences, and each task looks its documents up in it.

Defined results: null texts count as empty and hold one end id; a text longer
than the capacity is cut, its first piece being the short one; repeated rows
and ties of length get different places, in the order of the ids where they
differ; an empty table gives an empty result; other columns are not needed and
not read.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import ranked, stored, text_or_empty
from martlake.llm.flat import Mixers, WordCache, chunks, codepoints, kept, small_batches, span_hashes
from martlake.llm.merging import Merger

CAPACITY = 2048
PLAIN_END = 0x2E80  # below it, the classes of characters are those of the tokenizer's pattern
LETTER, NUMBER, SPACE, OTHER = range(4)
# the contractions that the tokenizer's pattern splits off (fixed values)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


class Tokenizer:
    """Ids of a byte-level BPE tokenizer; each distinct word is encoded once.

    Words are found and merged with flat arrays, by the tables of the
    tokenizer's file. Texts with characters beyond the class table, or with a
    string that the tokenizer treats as special, go to the library as they are.
    """

    def __init__(self, path: str) -> None:
        import unicodedata

        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        model = json.loads(self.library.to_str())["model"]
        vocab = model["vocab"]
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        # byte-level vocabularies write a byte as itself where it prints, the others as code points from 256 on
        prints = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
        letters = {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(prints))}
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merger = Merger([(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)], max(vocab.values()) + 1)
        kinds = {"L": LETTER, "N": NUMBER}
        table = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(PLAIN_END)]
        for c in range(PLAIN_END):
            if chr(c).isspace() and not 0x1C <= c <= 0x1F:
                table[c] = SPACE
        self.kind = np.array(table, np.int8)
        self.cache, self.mixers = WordCache(self._encode_words), Mixers()

    def _encode_words(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), np.uint8)
        at = np.flatnonzero(np.append((raw & 0xC0) != 0x80, True))  # where each code point begins
        symbols, _, ends = self.merger.merge(self.byte_ids[raw], at[bounds])
        return symbols, ends

    def _word_starts(self, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        kind = self.kind[points]
        n = len(points)
        begin_text = np.zeros(n + 1, bool)
        begin_text[bounds] = True
        at_begin = begin_text[:-1]
        begins = np.append(True, kind[1:] != kind[:-1]) | at_begin  # of runs of one kind
        space = kind == SPACE
        # the last white space before a word goes with the word if it is a blank, and is a word of its own otherwise
        last = space & ~np.append(space[1:], True) & ~begin_text[1:]
        last[-1] = False
        begins |= last
        after_last = np.flatnonzero(last) + 1
        begins[after_last] = points[after_last - 1] != 0x20
        # an apostrophe that stands alone before a contraction's letters
        lone = (points == 0x27) & begins & (np.append(begins[1:], True))
        for i in np.flatnonzero(lone).tolist():
            rest = points[i + 1 : i + 3].tobytes().decode("utf-32-le")
            for c in CONTRACTIONS:
                if rest.startswith(c) and not begin_text[i + 1 : i + 1 + len(c)].any():
                    begins[i + 1] = False
                    if i + 1 + len(c) < n:
                        begins[i + 1 + len(c)] = True
                    break
        return np.flatnonzero(begins)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text begin."""
        points, bounds = codepoints(texts)
        if not len(points):
            return np.zeros(0, np.int64), bounds
        beyond = points >= PLAIN_END
        odd = {i for i in np.searchsorted(bounds, np.flatnonzero(beyond), side="right") - 1}
        odd |= {i for i, t in enumerate(texts) if any(s in t for s in self.special)}
        if odd:
            rest = [i for i in range(len(texts)) if i not in odd]
            own, at = self.encode([texts[i] for i in rest])
            rows: list = [None] * len(texts)
            for k, i in enumerate(rest):
                rows[i] = own[at[k] : at[k + 1]]
            for i in odd:
                rows[i] = np.array(self.library.encode(texts[i], add_special_tokens=False).ids, np.int64)
            at = np.zeros(len(texts) + 1, np.int64)
            np.cumsum([len(r) for r in rows], out=at[1:])
            return np.concatenate(rows), at
        starts = self._word_starts(points, bounds)
        ends = np.append(starts[1:], len(points))
        ids, at = self.cache.ids(span_hashes(points, starts, ends, self.mixers), starts, ends, points)
        return ids, at[np.searchsorted(starts, bounds)]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = kept(("byte_bpe", tokenizer_path), lambda: Tokenizer(tokenizer_path))
        end = np.array([end_id], np.uint32)
        for batch in small_batches(batches):
            texts = batch.column(1).to_pylist()
            for a, b in chunks(texts):
                ids, at = tokenizer.encode(texts[a:b])
                ids, cut = ids.astype("<u4"), at.tolist()
                out = []
                for k, (lo, hi) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
                    whole = np.concatenate([ids[lo:hi], end])
                    first = len(whole) % capacity or capacity
                    for piece, start in enumerate([0, *range(first, len(whole), capacity)]):
                        part = whole[start : first if piece == 0 else start + capacity]
                        out.append((a + k, piece, start, len(part), zlib.crc32(part.tobytes())))
                row, *rest = (pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(row), *rest], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """The plan for ``counts`` documents of each length.

    Rows (rank, sequence, per_sequence, offset, length): from that rank on, and
    up to the rank of the next row, ``per_sequence`` documents of ``length`` go
    to each sequence in turn, the first of them to ``sequence`` at ``offset``.
    """
    plan, gaps = [], defaultdict(list)  # gap -> intervals [first sequence, end)
    rank = opened = 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left = counts[length]
        while left:
            gap = next((g for g in range(length, capacity) if gaps.get(g)), None)  # the successor
            if gap is None:
                gap, each = capacity, capacity // length
                lo, hi = opened, opened + -(-left // each)
                opened = hi
            else:
                each = gap // length
                lo, hi = gaps[gap].pop()
                need = -(-left // each)
                if need < hi - lo:
                    gaps[gap].append((lo + need, hi))
                    hi = lo + need
            placed = min(left, each * (hi - lo))
            plan.append((rank, lo, each, capacity - gap, length))
            full = placed // each
            gaps[gap - each * length].append((lo, lo + full))
            if placed % each:
                gaps[gap - placed % each * length].append((lo + full, lo + full + 1))
            gaps[gap - each * length] = [x for x in gaps[gap - each * length] if x[0] < x[1]]
            rank += placed
            left -= placed
    return plan


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to capacity)."""
    parts = stored(parts, "pieces")  # the range sort reads its input twice; texts are encoded once
    # the stored row's number tells rows with one id apart, so that the range sort can split any number of them
    numbered = parts.withColumn("_row", F.monotonically_increasing_id())
    rows = ranked(numbered, [F.col("length").desc(), F.col("doc_id"), F.col("piece"), F.col("_row")], "packing").drop("_row")
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # a row for each length
    plan = np.array(best_fit(counts, capacity), np.int64).reshape(-1, 5)
    schema = rows.drop("rank").schema.add("sequence_id", "long").add("offset", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            first, sequence, each, offset, length = plan[np.searchsorted(plan[:, 0], rank, side="right") - 1].T
            turn = rank - first
            columns = [batch.column(f.name) for f in schema.fields[:-2]]
            places = [pa.array(sequence + turn // each), pa.array(offset + turn % each * length)]
            yield pa.RecordBatch.from_arrays([*columns, *places], schema.names)

    return rows.mapInArrow(run, schema)
