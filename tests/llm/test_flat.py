"""Words that the hashes of a plain polynomial can't tell apart, and caches that are wrong about a hash."""

from __future__ import annotations

import numpy as np
import pytest
import sentencepiece
import tokenizers

from martlake.llm import jaccard_join, packing, sentencepiece_bpe
from martlake.llm.flat import Mixers, WordCache, codepoints, span_hashes
from martlake.llm.queries import BYTE_BPE, PIECE_BPE


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join((a, b)[i.bit_count() % 2] for i in range(n))


PAIRS = [(thue_morse(n, a, b), thue_morse(n, b, a)) for n in (64, 1024, 4096) for a, b in ("ab", "xy", "01")]


def hashes(words: list[str]) -> np.ndarray:
    points, bounds = codepoints(words)
    return span_hashes(points, bounds[:-1], bounds[1:], Mixers())


def test_regular_words_differ():
    rng = np.random.default_rng(0)
    words = {w for pair in PAIRS for w in pair} | {"".join(rng.choice(["a", "b"], 80)) for _ in range(3000)}
    words |= {"a" * k for k in range(1, 200)} | {chr(c) for c in range(33, 3000)} | {"ab", "ba", "abab", "baba"}
    assert len(set(hashes(sorted(words)).tolist())) == len(words)


def test_hashes_are_those_of_the_words_wherever_they_stand():
    points, _ = codepoints(["  one two  one three one"])
    starts, ends = np.array([2, 6, 11, 15, 21]), np.array([5, 9, 14, 20, 24])
    got = span_hashes(points, starts, ends, Mixers())
    assert got.tolist() == hashes(["one", "two", "one", "three", "one"]).tolist()
    assert hashes([]).tolist() == [] and len(set(hashes(["", "a"]).tolist())) == 2


@pytest.mark.parametrize("most", [500_000, 3])
def test_cache_compares_characters(most):
    encoded = []

    def encode(points, bounds):  # a word's ids: its code points
        encoded.append(len(bounds) - 1)
        return points.astype(np.int64), bounds

    cache = WordCache(encode, most)
    words = ["one", "two", "one", "three", "", "two", "six"]
    points, bounds = codepoints(words)
    for same in (np.zeros(7, np.uint64), np.array([1, 1, 1, 2, 2, 1, 1], np.uint64), np.arange(7, dtype=np.uint64) % np.uint64(2)):
        ids, at = cache.ids(same, bounds[:-1], bounds[1:], points)  # hashes that are all wrong
        assert ["".join(map(chr, ids[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)] == words
    assert len(encoded) > 3


def test_ids_of_regular_words_are_those_of_the_libraries():
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)
    bytes_library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    codec, tokenizer = sentencepiece_bpe.Codec(PIECE_BPE), packing.Tokenizer(BYTE_BPE)
    for pair in PAIRS:
        for text in (*pair, " ".join(pair)):  # the second after the first, in one worker
            ids, at = codec.encode([text])
            assert ids.tolist() == pieces.encode(text)
            assert [t.decode() for t in codec.decode(ids, at)] == [text]
            assert tokenizer.encode([text])[0].tolist() == bytes_library.encode(text, add_special_tokens=False).ids


def test_regular_words_link_no_documents(spark):
    rows = [(2 * i + k, word) for i, pair in enumerate(PAIRS) for k, word in enumerate(pair)]
    rows += [(100 + i, f"{w} again") for i, w in rows]
    out = jaccard_join.with_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(i, i) for i, _ in rows}
