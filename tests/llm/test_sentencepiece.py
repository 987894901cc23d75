from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from martlake.llm import sentencepiece_bpe
from martlake.llm.queries import op5_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", " ", "a  b", "  x ", "\n\na\tb", "ｆｕｌｌ", "é́", "日本", "<s>", "▁a", "a▁b", "\xa0x", "a\x00b", "<0x0A>", "😀", "a" * 3000, "ab" * 900, " " * 77, "the" * 300, "-=" * 200, "㍿𐍈"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_bpe.Codec(PATH)


def check(codec, library, texts):
    ids, at = codec.encode(texts)
    want = [library.encode(t) for t in texts]
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == want
    assert [t.decode() for t in codec.decode(ids, at)] == [library.decode(w) for w in want]


def test_like_the_library(codec, library):
    check(codec, library, TEXTS)
    check(codec, library, TEXTS[::-1])  # now from the cache


@pytest.mark.parametrize("alphabet", ["abcdefghij klmnopqrstuvwxyz ABC.,\n éüñ▁日😀 ", "abae ", "  \n", ["the", "in", "g", "er", " ", "   ", "tion"]])
def test_random_texts(codec, library, alphabet):
    rnd = random.Random(5)
    check(codec, library, ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 200))) for _ in range(400)])


def test_cache_that_overflows(library):
    codec = sentencepiece_bpe.Codec(PATH)
    codec.cache.most = 5
    check(codec, library, [f"word{i} other{i % 7}" for i in range(50)])
    check(codec, library, [f"word{i} other{i % 7}" for i in range(50)])


def test_tables(spark, library):
    rows = [(2**60 + 1, None, 1), (None, "x y", 2), (3, "", 3), (3, "", 3), (4, "long " * 100_000, 4), (5, "é 日本", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = sentencepiece_bpe.digests(docs, PATH).collect()
    want = []
    for doc_id, text, _ in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got), key=str) == sorted(want, key=str)
    again = sentencepiece_bpe.decode(sentencepiece_bpe.encode(docs, PATH), PATH).collect()
    assert all(r.decoded == library.decode(list(r.ids)) for r in again) and len(again) == len(rows)
    assert sentencepiece_bpe.digests(docs.limit(0), PATH).count() == 0


def test_query(spark, tables, library):
    got = {r.doc_id: r for r in op5_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    docs = tables("documents", "/root/testdata/sf0.001")
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d["text"] or "")
        assert got[d["doc_id"]].n_tokens == len(ids)
        assert got[d["doc_id"]].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
