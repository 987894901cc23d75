from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import tokenizers
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from martlake.llm.queries import BYTE_BPE, table

SF = "/root/testdata/sf0.01"


def extra(spark, docs):
    """Rows with nulls, empty, long, repeated and toxic texts."""
    rows = [
        (None, None, None, None, None),
        (900001, None, "en", "src0", 0),
        (900002, "", "en", "src0", 0),
        (900003, "idiot " * 3 + "the and of to in is", "en", "src0", 30),
        (900004, "The and of " * 50_000, "en", None, 600_000),
        (900004, "The and of " * 50_000, "en", None, 600_000),
    ]
    return docs.unionByName(spark.createDataFrame(rows, docs.schema))


def test_stages(spark, tables, tmp_path):
    docs = extra(spark, table(spark, SF, "documents"))
    labels = {x["doc_id"]: x for x in tables("labels")}
    kept = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, kept[-1], SF).write.parquet(str(tmp_path / str(k)))
        kept.append(spark.read.parquet(str(tmp_path / str(k))))
        if k < 4:
            assert kept[-1].columns == docs.columns
    ids = [{r.doc_id for r in d.select("doc_id").collect()} for d in kept]
    assert 900003 not in ids[1]
    wrong = [i for i in labels if i in ids[0] and (i not in ids[1]) != bool(labels[i]["toxic"])]
    assert len(wrong) <= 2
    wrong = [i for i in labels if i in ids[1] and (i in ids[2]) != bool(labels[i]["quality"])]
    assert len(wrong) <= 0.03 * len(labels)
    texts = {r.doc_id: r.text for r in kept[3].collect()}
    assert kept[3].filter("doc_id is not null").count() == len(ids[3] - {None})
    from tests.llm.test_jaccard import brute

    groups = brute([(r.doc_id, r.text) for r in kept[2].select("doc_id", "text").distinct().collect()])
    assert {g for _, _, g in groups} == ids[3]
    redacted = {r.doc_id: r for r in kept[4].collect()}
    assert set(redacted) == set(texts)
    for i, r in redacted.items():
        if r.text is not None and "@mail" in (texts[i] or ""):
            assert "[EMAIL]" in r.text and "@mail" not in r.text and r.n_chars == len(r.text)
        elif texts[i] is None or "[" not in (r.text or ""):
            assert r.text == texts[i]
    assert {r.doc_id for r in kept[5].select("doc_id").collect()} == ids[4]


def test_empty_documents_and_run(spark, tmp_path):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_registered():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert "op6_exact_topk" in __spark_entry__.oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "personal_data", "packing"]


CLASHING = ("_head", "_found", "_spans", "_base_email", "_key", "_row", "doc_id_", "component_id", "severity", "predicted", "toxic")


def test_columns_that_clash_pass_through(spark, tables):
    docs = table(spark, SF, "documents").filter("doc_id < 300")
    for c in CLASHING:
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")))
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
    rows = kept.collect()
    assert rows and all(r[c] == f"{c} {r.doc_id}" for r in rows for c in CLASHING)
    plain = docs.select(*table(spark, SF, "documents").columns)
    for _, stage in corpus_pipeline.STAGES[:4]:
        plain = stage(spark, plain, SF)
    assert {tuple(r) for r in plain.collect()} == {tuple(r[c] for c in plain.columns) for r in rows}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    words = [" ".join(f"{x}{i}" for i in range(60)) for x in "abcd"]
    rows = [
        (5, words[0]),
        (5, words[1]),  # another text under the same id
        (5, words[1]),
        (6, words[1] + " more"),
        (None, words[2]),
        (None, words[2] + " tail"),
        (7, words[2]),
        (None, words[3]),
        (None, words[3]),
        (8, None),
        (9, ""),
        (9, ""),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = Counter(tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect())
    assert kept == Counter([(5, words[0]), (5, words[1]), (7, words[2]), (None, words[3]), (8, None), (9, ""), (9, "")])


def test_run(spark, tables):
    """No document is lost or made up between the stages, and sequences have no gaps."""
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, sf)
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts and set(texts) <= {d["doc_id"] for d in tables("documents", sf)}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    library = tokenizers.Tokenizer.from_file(BYTE_BPE)
    for i, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    sequences: dict = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert len(sequences) <= -(-sum(r.length for r in rows) // 2048) * 1.1 + 1
