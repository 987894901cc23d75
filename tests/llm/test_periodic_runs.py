from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martlake.llm import periodic_runs, queries
from tests.llm.conftest import SF

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by comparing all words at all distances."""
    found, extents = [], set()
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if j > i and end - start >= 4 * q and (start, end) not in extents:
                extents.add((start, end))
                if end - start >= 6:
                    found.append((start, end - start, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id: int | None, text: str | None) -> tuple:
    words = WORDS.findall(text or "")
    if doc_id is not None and words:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(words)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    dropped = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        sha("".join(f"{s},{l},{q}\n" for s, l, q in runs)),
        sha(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def found_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    words, bounds = periodic_runs._numbered([[str(w).encode() for w in t] for t in texts])
    out: list[list] = [[] for _ in texts]
    for t, *run in periodic_runs.find_runs(words, bounds).tolist():
        out[t].append(tuple(run))
    return out


words = st.lists(st.integers(0, 2), max_size=60)
repeated = st.tuples(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), min_size=1, max_size=14), st.integers(1, 90), words).map(
    lambda x: x[0] + (x[1] * x[2])[: 90 + x[2]] + x[3]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(words, repeated), max_size=6))
def test_runs_equal_brute_force(texts):
    assert found_runs(texts) == [brute_runs(t) for t in texts]


def test_periods_at_all_scales():
    rng = np.random.default_rng(3)
    texts = []
    for q in [1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 63, 64, 65, 100]:
        for length in (4 * q - 1, 4 * q, 4 * q + 1, 6 * q + 2):
            texts.append([*rng.integers(100, 200, 9), *np.resize(rng.integers(0, 30, q), length), *rng.integers(200, 300, 5)])
    assert found_runs(texts) == [brute_runs([int(w) for w in t]) for t in texts]


def test_nested_and_neighbouring_runs():
    inner = [1, 1, 1, 1, 1, 1, 2, 3]
    texts = [inner * 5, (inner * 4 + [9]) * 4, [1, 2] * 6 + [1, 3] * 6, ([0] * 20 + [1]) * 4, [5] * 3000, [1, 2, 1, 1, 2] * 200 + [1, 2] * 100]
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 400:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    texts += [fibonacci[-1], fibonacci[-1] * 4]
    assert found_runs(texts) == [brute_runs(t) for t in texts]


CASES = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "a b c"),
    (5, "x " * 6),
    (5, "x " * 6),
    (6, "x y " * 7),  # no-break spaces belong to words
    (None, "a b " * 9),
    (7, "é\x0bß\x0c" * 8 + "end"),
    *[(i, "one two three four five six seven eight nine ten " * (1 + i % 7)) for i in range(100, 180)],
    (8, " ".join(str(i * i % 977) for i in range(30000)) + " again and again" * 900),
]


def test_query_rows_equal_brute_force(spark, tmp_path):
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t, "en", [1]) for i, t in CASES], "doc_id long, text string, lang string, runs array<int>").write.parquet(path)
    rows = queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    quick = [c for c in CASES if len(c[1] or "") < 10_000]
    got = sorted((tuple(r) for r in rows if r.doc_id != 8), key=repr)
    assert got == sorted((brute_row(*c) for c in quick), key=repr)
    (long,) = [r for r in rows if r.doc_id == 8]
    # i * i % 977 has period 977; with "again and again" behind it
    assert (long.n_runs, long.start, long.length, long.period) == (2, 0, 30000, 977)


def test_query_on_given_documents(spark, tables):
    sample = [d for d in tables("documents") if len(d["text"] or "") < 6000]
    got = {r.doc_id: tuple(r) for r in queries.QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert len(got) == len(tables("documents"))
    assert [got[d["doc_id"]] for d in sample] == [brute_row(d["doc_id"], d["text"]) for d in sample]
    assert sum(g[1] > 0 for g in got.values()) > 20


def test_operator_outputs_and_columns(spark):
    rows = spark.createDataFrame([("a b " * 4 + "c", 1), (None, 2)], "body string, collapsed int")
    out = periodic_runs.with_runs(rows, "body")
    assert out.columns == ["body", "runs", "collapsed"]
    found = {r.body: ([tuple(x) for x in r.runs], r.collapsed) for r in out.collect()}
    assert found == {"a b " * 4 + "c": ([(0, 8, 2)], "a b c"), None: ([], "")}


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("slice_bytes", [1, 50])
def test_slices_do_not_matter(spark, monkeypatch, slice_bytes):
    rows = [(i, "p q r s " * (i % 9)) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {tuple(r) for r in periodic_runs.digests(docs).collect()}
    monkeypatch.setattr(periodic_runs, "SLICE", slice_bytes)
    assert {tuple(r) for r in periodic_runs.digests(docs).collect()} == whole == {brute_row(*r) for r in rows}
