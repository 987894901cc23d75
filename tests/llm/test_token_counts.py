from __future__ import annotations

import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from martlake.llm import queries, token_counts
from martlake.llm.queries import BYTE_BPE, PIECE_BPE
from tests.llm.conftest import SF

TEXTS = [None, "", " ", "a b", "a▁b", "  two  spaces\t\n", "<s> </s> <unk> <0x41> <|endoftext|>", "naïve ﬁ 漢字 🙂", "\x00\x1f", "word " * 5000]


def library_counts(texts: list, path: str) -> list[int]:
    texts = [t or "" for t in texts]
    if path.endswith(".model"):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return [len(sp.encode(t)) for t in texts]
    tokenizer = tokenizers.Tokenizer.from_file(path)
    return [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in texts]


def frame(spark, texts: list):
    return spark.createDataFrame([(i, t, "en", -1) for i, t in enumerate(texts)], "doc_id long, text string, lang string, n_tokens int")


def rows_of(df) -> dict:
    return {r.doc_id: (r.lang, r.n_bytes, r.n_tokens) for r in df.collect()}


def expected(texts: list, path: str) -> dict:
    return {i: ("en", len((t or "").encode()), n) for (i, t), n in zip(enumerate(texts), library_counts(texts, path), strict=True)}


def batches(spark, folder, path) -> list[list]:
    cache = token_counts.Cache(spark, str(folder), token_counts.Tokenizer(path).version)
    try:
        rows = spark.read.parquet(cache.path).collect()
    except Exception:  # noqa: BLE001 - nothing stored yet
        return []
    names = {r.batch for r in rows}
    return sorted(([r for r in rows if r.batch == b] for b in names), key=len)


@pytest.mark.parametrize("path", [PIECE_BPE, BYTE_BPE])
def test_counts_equal_library(spark, tmp_path, path):
    texts = [*TEXTS, *TEXTS, "only here"]
    out = token_counts.with_token_counts(frame(spark, texts), path, str(tmp_path))
    assert out.columns == ["doc_id", "lang", "n_bytes", "n_tokens"]
    assert rows_of(out) == expected(texts, path)
    distinct = len({(t or "").replace("▁", " ") if path == PIECE_BPE else t or "" for t in texts})
    assert [len(b) for b in batches(spark, tmp_path, path)] == [distinct]


def test_only_misses_are_encoded(spark, tmp_path):
    first = [t for t in TEXTS if t != "a b"]
    token_counts.with_token_counts(frame(spark, first), PIECE_BPE, str(tmp_path))
    assert len(batches(spark, tmp_path, PIECE_BPE)) == 1
    out = token_counts.with_token_counts(frame(spark, TEXTS), PIECE_BPE, str(tmp_path))  # "a b" has the normal form of "a▁b"
    assert rows_of(out) == expected(TEXTS, PIECE_BPE)
    assert len(batches(spark, tmp_path, PIECE_BPE)) == 1
    more = [*TEXTS, "new", "new", "newer"]
    assert rows_of(token_counts.with_token_counts(frame(spark, more), PIECE_BPE, str(tmp_path))) == expected(more, PIECE_BPE)
    assert [len(b) for b in batches(spark, tmp_path, PIECE_BPE)] == [2, 8]


def test_stored_counts_are_used(spark, tmp_path):
    tokenizer = token_counts.Tokenizer(PIECE_BPE)
    cache = token_counts.Cache(spark, str(tmp_path), tokenizer.version)
    (digest,) = tokenizer.digests(["planted"])
    for _ in range(2):  # a digest may be stored twice
        cache.append(spark.createDataFrame([(bytearray(digest), 4711)], token_counts.COUNTS))
    out = token_counts.with_token_counts(frame(spark, ["planted", "not planted"]), PIECE_BPE, str(tmp_path))
    assert {i: r[2] for i, r in rows_of(out).items()} == {0: 4711, 1: library_counts(["not planted"], PIECE_BPE)[0]}


def test_tokenizers_do_not_share_counts(spark, tmp_path):
    for path in (PIECE_BPE, BYTE_BPE, PIECE_BPE):
        assert rows_of(token_counts.with_token_counts(frame(spark, TEXTS), path, str(tmp_path))) == expected(TEXTS, path)
    versions = {token_counts.Tokenizer(p).version for p in (PIECE_BPE, BYTE_BPE)}
    assert len(versions) == 2 and [len(batches(spark, tmp_path, p)) for p in (PIECE_BPE, BYTE_BPE)] == [1, 1]


def test_hot_text_is_handed_on_once_for_each_task(spark, monkeypatch):
    docs = spark.range(2000).repartition(3).select(F.lit("the same").alias("text"))
    assert token_counts._texts(docs, PIECE_BPE, "text").count() <= 3
    rows = spark.range(300).repartition(2).select((F.col("id") % 7).cast("string").alias("text"))
    monkeypatch.setattr(token_counts, "REMEMBERED", 2)
    assert {r.text for r in token_counts._texts(rows, PIECE_BPE, "text").collect()} == set("0123456")


def test_query_on_given_documents(spark, tables):
    docs = tables("documents")
    out = queries.QUERIES["op11_token_counts"](spark, SF)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    counts = library_counts([d["text"] for d in docs], PIECE_BPE)
    want = {(d["doc_id"], len((d["text"] or "").encode()), n, n > 4096) for d, n in zip(docs, counts, strict=True)}
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(docs) and set(rows) == want
    assert any(r[3] for r in rows) and not all(r[3] for r in rows)


def test_empty_table_and_unknown_file(spark, tmp_path):
    assert token_counts.with_token_counts(frame(spark, TEXTS).limit(0), PIECE_BPE, str(tmp_path)).collect() == []
    assert batches(spark, tmp_path, PIECE_BPE) == []
    with pytest.raises(ValueError, match="no library"):
        token_counts.Tokenizer("vocabulary.txt")
