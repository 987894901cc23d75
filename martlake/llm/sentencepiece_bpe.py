"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

Texts become flat arrays of symbols. In each round every word finds its best
pair (a segmented minimum of pair ranks), all words merge at the same time,
and the arrays are compacted, until no word has a pair left. The pieces, their
scores and the byte fallback come from the model file; the library is needed
only to read that file.

Defined results: null texts count as empty; empty texts have no ids; rows are
independent of each other, so repeated rows and ids give repeated results;
other columns pass through unless they clash with the added ones, which win.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import text_or_empty
from martlake.llm.flat import Mixers, WordCache, chunks, codepoints, gather, kept, ragged, small_batches, span_hashes
from martlake.llm.merging import Merger

SPACE = "▁"


class Model:
    """What the merge rounds need from a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(size)]
        scores = {i: sp.get_score(i) for i in range(size) if not special[i]}
        ids = {pieces[i]: i for i in scores}
        if any(sp.is_unused(i) for i in range(size)) or any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("the model has unused pieces or pieces with a space inside")
        self.size = size
        self.byte_ids = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = []
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
                if left is not None and right is not None:
                    pairs.append((left, right, order[scores[i]], i))
        self.merger = Merger(pairs, size)
        self.char = np.full(0x110000, size, np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.char[ord(piece)] = i
        plain = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        plain[sp.unk_id()] = " ⁇ ".encode()
        self.plain, self.plain_at = ragged(plain)
        self.plain = self.plain.astype(np.uint8)
        self.digits, self.digits_at = ragged([f"{i},".encode() for i in range(size)])
        self.digits = self.digits.astype(np.uint8)

    def encode_words(self, points: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        symbols, chars, ends = self.merger.merge(self.char[points].astype(np.int64), bounds)
        unknown = np.flatnonzero(symbols == self.size)
        if len(unknown):  # characters without a piece become bytes
            lone = points[chars[unknown]]
            sizes = np.ones(len(symbols), np.int64)
            sizes[unknown] += (lone > 0x7F).astype(np.int64) + (lone > 0x7FF) + (lone > 0xFFFF)
            at = np.zeros(len(symbols) + 1, np.int64)
            np.cumsum(sizes, out=at[1:])
            is_byte = np.repeat(symbols == self.size, sizes)
            symbols = np.repeat(symbols, sizes)
            raw = lone.astype(np.uint32).tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            symbols[is_byte] = self.byte_ids[np.frombuffer(raw, np.uint8)]
            ends = at[ends]
        return symbols, ends


class Codec:
    """Encodes and decodes texts; keeps the ids of words seen lately."""

    def __init__(self, path: str) -> None:
        self.model = Model(path)
        self.cache, self.mixers = WordCache(self.model.encode_words), Mixers()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where those of each text begin."""
        marked = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        points, bounds = codepoints(marked)
        if not len(points):
            return np.zeros(0, np.int32), bounds
        space = points == ord(SPACE)
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[bounds[:-1][np.diff(bounds) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(points))
        ids, at = self.cache.ids(span_hashes(points, starts, ends, self.mixers), starts, ends, points)
        return ids, at[np.searchsorted(starts, bounds)]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of each text; the space that encoding put in front is taken away."""
        data, at = gather(self.model.plain, self.model.plain_at, ids)
        whole, cut = data.tobytes(), at[bounds].tolist()
        texts = [whole[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]
        return [(t[1:] if t[:1] == b" " else t).decode("utf-8", "replace").encode() for t in texts]

    def id_strings(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Decimal ids joined by commas."""
        data, at = gather(self.model.digits, self.model.digits_at, ids)
        whole, cut = data.tobytes(), at[bounds].tolist()
        return [whole[a : max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _per_text(docs: DataFrame, model_path: str, added: list[T.StructField], results) -> DataFrame:
    """``docs`` with columns that ``results(codec, texts)`` makes of the texts."""
    names = [f.name for f in added]
    others = [c for c in docs.columns if c.lower() not in {n.lower() for n in [*names, "_text"]}]
    rows = docs.select(*[F.col(f"`{c}`") for c in others], text_or_empty().alias("_text"))
    schema = T.StructType([*rows.schema.fields[:-1], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("piece_bpe", model_path), lambda: Codec(model_path))
        for batch in small_batches(batches):
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for a, b in chunks(texts):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, results(codec, texts[a:b]))], schema.names)

    return rows.mapInArrow(run, schema)


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """Adds ``ids`` (array of int) of the column ``text``; all ids of whole texts."""

    def results(codec: Codec, texts: list[str]) -> list:
        ids, at = codec.encode(texts)
        return [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]

    return _per_text(docs, model_path, [T.StructField("ids", T.ArrayType(T.IntegerType()))], results)


def decode(docs: DataFrame, model_path: str) -> DataFrame:
    """Adds ``decoded`` (string) of the column ``ids``; null ids count as none."""
    schema = T.StructType([f for f in docs.schema.fields if f.name.lower() != "decoded"] + [T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = kept(("piece_bpe", model_path), lambda: Codec(model_path))
        for batch in small_batches(batches):
            ids, at = ragged([r or () for r in batch.column("ids").to_pylist()])
            decoded = pa.array([t.decode() for t in codec.decode(ids, at)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in schema.names[:-1]), decoded], schema.names)

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256 of a round trip of each text."""

    def results(codec: Codec, texts: list[str]) -> list:
        ids, at = codec.encode(texts)
        return [
            np.diff(at),
            [hashlib.sha256(x).hexdigest() for x in codec.id_strings(ids, at)],
            [hashlib.sha256(x).hexdigest() for x in codec.decode(ids, at)],
        ]

    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return _per_text(docs, model_path, added, results)
