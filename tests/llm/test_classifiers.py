from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from martlake.llm import labelled, quality, toxicity
from martlake.llm.queries import op2_toxicity, op9_quality

SF = "/root/testdata/sf0.01"
DOCS, LABELS = "doc_id long, text string, score string, toxic string", "doc_id long, quality int, toxic int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def corpus(spark, n=200):
    rnd, docs, labels = random.Random(1), [], []
    for i in range(n):
        words = [rnd.choice(WORDS) for _ in range(rnd.randint(20, 60))]
        bad = i % 4 == 0
        for _ in range(rnd.randint(1, 8) if bad else 0):
            words[rnd.randrange(len(words))] = rnd.choice(["vile", "awful", "nasty"])
        docs.append((i, " ".join(words), "x", "y"))
        labels.append((i, int(not bad), int(bad)))
    docs += [(n, None, "x", "y"), (n + 1, "", None, None), (n + 2, "   ", "x", "y"), (None, "vile words", "x", "y"), (5, docs[5][1], "x", "y"), (n + 3, "alpha " * 60_000 + "vile", "x", "y")]
    labels += [(None, 1, 0), (n + 9, None, None), (5, 1, 0), (7, 0, 1)]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)


def test_severity_grows_with_markers(spark):
    docs, labels = corpus(spark)
    model = toxicity.fit(docs, labels)
    assert (np.diff(model.thresholds) > 0).all()
    rows = toxicity.with_severity(docs, model).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() and "score" in rows[0].asDict()
    wrong = [i for i in range(200) if got[i].toxic != (i % 4 == 0) and i != 7]
    assert len(wrong) <= 4  # few words, and one wrong label
    assert not got[200].toxic and not got[201].toxic and got[200].severity == got[201].severity == got[202].severity
    assert got[None].toxic and got[203].toxic  # one marker in a very long text
    lines = [(1, "alpha beta vile"), (2, "alpha beta vile awful"), (3, "alpha beta vile awful nasty vile awful nasty vile awful")]
    s = {r.doc_id: r.severity for r in toxicity.with_severity(spark.createDataFrame(lines, "doc_id long, text string"), model).collect()}
    assert 0 < s[1] < s[2] < s[3] <= 3


def test_chances_of_grades_sum_to_one_and_match_a_plain_likelihood():
    rng = np.random.default_rng(0)
    n, width = 400, 5
    x = rng.poisson(0.7, (n, width)).astype(float)
    truth = x @ np.array([1.5, 0.8, 0, 0, -1.0]) + rng.logistic(size=n)
    grade = np.digitize(truth, [1.0, 2.0, 3.5])
    row, column = np.nonzero(x)
    weights, thresholds = toxicity.fit_ordinal(row, column, x[row, column], grade, width, np.full(n, 1 / n))
    chance = toxicity.Model(np.zeros(width, np.uint64), weights, thresholds).grades(row, column, x[row, column], n)
    assert np.allclose(chance.sum(1), 1) and (chance >= 0).all()
    assert np.corrcoef(chance @ np.arange(4), grade)[0, 1] > 0.6

    def loss(w, theta):
        above = 1 / (1 + np.exp(-(x @ w)[:, None] + theta))
        edges = np.hstack([np.ones((n, 1)), above, np.zeros((n, 1))])
        return -np.log(edges[np.arange(n), grade] - edges[np.arange(n), grade + 1]).mean() + 0.5e-5 * (w**2).sum()

    best = loss(weights, thresholds)
    for _ in range(100):  # no step near the fit is better
        assert loss(weights + rng.normal(0, 0.05, width), thresholds) > best - 1e-5


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(1, 0, 1), (2, 0, 1)]])
def test_labels_of_one_class(spark, labels):
    docs, _ = corpus(spark, 8)
    known = spark.createDataFrame(labels, LABELS)
    rows = toxicity.with_severity(docs, toxicity.fit(docs, known)).collect()
    assert len({r.toxic for r in rows}) == 1 and rows[0].toxic == bool(labels and labels[0][2])
    scores = {r.score for r in quality.with_score(docs, quality.fit(docs, known)).collect()}
    assert len(scores) == 1 and (not labels or (scores.pop() > 0.5) == bool(labels[0][1]))


def test_empty_tables(spark):
    docs, labels = corpus(spark, 40)
    none = docs.limit(0)
    assert toxicity.with_severity(none, toxicity.fit(none, labels)).count() == 0
    assert quality.with_score(none, quality.fit(none, labels)).count() == 0


def test_sample_is_bounded_and_balanced(spark):
    docs, labels = corpus(spark)
    rows = labelled.sample(docs, labels, "toxic", 10).collect()
    assert len({r.doc_id for r in rows if r.label == 1}) <= 10 and len({r.doc_id for r in rows if r.label == 0}) <= 10
    assert rows == labelled.sample(docs, labels, "toxic", 10).collect()


def test_toxicity_query(spark, tables):
    got = {r.doc_id: r for r in op2_toxicity(spark, SF).collect()}
    assert len(got) == len(tables("documents"))
    wrong = [x["doc_id"] for x in tables("labels") if got[x["doc_id"]].toxic != bool(x["toxic"])]
    assert len(wrong) <= 2


def test_quality_query_on_held_out_rows(spark, tables):
    got = {r.doc_id: r for r in op9_quality(spark, SF).collect()}
    assert len(got) == len(tables("documents"))
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [x for x in tables("labels") if got[x["doc_id"]].held_out]
    right = sum(got[x["doc_id"]].predicted == x["quality"] for x in held)
    assert right >= 0.95 * len(held)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = corpus(spark, 120)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first = {r.doc_id: r.score for r in quality.with_score(docs, quality.fit(docs, labels)).collect()}
    second = {r.doc_id: r.score for r in quality.with_score(docs, quality.fit(docs, turned)).collect()}
    assert first == second


def test_context_table_counts_neighbours(spark):
    texts = ["a b c", "b c, d", "", None, "a"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    got = quality.context_table(docs)
    dims, signs = quality.index_vectors()
    want = np.zeros((quality.BUCKETS, quality.WIDTH))
    for t in texts:
        bucket, _ = quality._buckets([t or ""])
        for i in range(len(bucket)):
            for j in range(len(bucket)):
                if 0 < abs(i - j) <= quality.REACH:
                    np.add.at(want, (bucket[i], dims[bucket[j]]), signs[bucket[j]])
    assert (got == want).all() and want.any()


def test_pooling_in_slices(monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(quality.BUCKETS, 6)).astype(np.float32)
    texts = ["a b c d e f g", "", "one", "x x x x x", "p q " * 30]
    whole = quality.pooled(texts, vectors)
    monkeypatch.setattr(quality, "SLICE", 3)
    assert np.allclose(quality.pooled(texts, vectors), whole, atol=1e-5)
    bucket, _ = quality._buckets([texts[0]])
    own = vectors[bucket]
    assert np.allclose(whole[0, :6], own.mean(0), atol=1e-5) and np.isclose(whole[0, 7], np.mean([a @ b for a, b in zip(own, own[1:])]), atol=1e-5)


def test_temperature_calibrates():
    rng = np.random.default_rng(2)
    logit = rng.normal(0, 2, 20_000)
    y = (rng.random(20_000) < 1 / (1 + np.exp(-logit))).astype(int)
    assert abs(quality.fit_temperature(logit * 5, y) - 5) < 0.4


def test_labels_without_a_document_take_no_place(spark):
    docs, labels = corpus(spark)
    present = docs.filter("doc_id between 100 and 199")
    rows = labelled.sample(present, labels, "toxic", 20).collect()
    assert [sum(r.label == k for r in rows) for k in (0, 1)] == [20, 20]
    assert {r.label: r.n for r in labelled.label_counts(present, labels, "toxic").collect()} == {0: 75, 1: 25}


@pytest.mark.parametrize("kept", [0, 1])
def test_stages_keep_all_where_a_class_is_missing(spark, tmp_path, kept):
    docs, labels = corpus(spark, 40)
    labels.filter(f"toxic = {kept}").write.parquet(str(tmp_path / "labels.parquet"))
    docs = docs.filter("doc_id < 40")
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.drop_low_quality):
        assert stage(spark, docs, str(tmp_path)).count() == docs.count()


def test_sample_takes_one_row_of_an_id(spark):
    from martlake.llm.labelled import sample

    docs = spark.range(500).select(F.lit(1).alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 7).cast("string")).alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(2, "other"), (2, None)], "doc_id int, text string"))
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, toxic int")
    rows = sample(docs, labels, "toxic", 1).collect()
    assert sorted((r.doc_id, r.label) for r in rows) == [(1, 0), (2, 1)]
    assert {tuple(r) for r in rows} == {tuple(r) for r in sample(docs.orderBy(F.rand(3)), labels, "toxic", 1).collect()}
