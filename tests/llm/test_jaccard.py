from __future__ import annotations

import random
import re

import numpy as np
import pytest

from martlake.llm import jaccard_join, shingles
from martlake.llm.components import components
from martlake.llm.queries import op3_jaccard_join

SCHEMA = "doc_id long, text string, n_shingles int, s string"
LOWER = {c: c + 32 for c in range(65, 91)}


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """(doc_id, n_shingles, component_id) of all rows, by comparing all pairs."""
    sets = [(d, plain_set(t)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    usable = [(d, s) for d, s in sets if d is not None and s]
    for i, (d, s) in enumerate(usable):
        for e, t in usable[:i]:
            if 100 * len(s & t) >= 80 * len(s | t):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return sorted(((d, len(s), None if d is None else root(d)) for d, s in sets), key=str)


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.with_components(docs).collect()), key=str)


def corpus(seed, bases=6, copies=12, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choice(words) for _ in range(30))
    rows, doc_id = [], 0
    for _ in range(bases):
        base = [rnd.choice(words) for _ in range(n)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            text = text[: rnd.randint(n - 8, n)]
            rows.append((doc_id, " ".join(text) + (" " + passage if rnd.random() < 0.3 else "")))
            doc_id += 1
    rows += [(doc_id + i, passage + " " + " ".join(rnd.choice(words) for _ in range(3 + i % 5))) for i in range(15)]
    return rows


EDGES = [
    (100, None),
    (101, ""),
    (102, " \t\n\x0b\x0c\r "),
    (103, "one two"),
    (104, "ONE  two"),
    (105, "one two three four five"),
    (106, "One Two Three Four Five"),
    (107, "É a b c d"),
    (108, "é a b c d"),
    (109, "a\xa0b c d e f"),
    (None, "one two"),
    (None, None),
    (110, "same id one two three four"),
    (110, "other text of the same id entirely"),
    (99, "other text of the same id entirely"),
    (98, "same id one two three four"),
    (111, "word " * 40_000),
    (112, "word " * 30_000),
    (113, "word"),
]


def test_edges(spark):
    got = run(spark, EDGES)
    want = brute(EDGES)
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed) + EDGES[:8]
    random.Random(seed).shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_regions_that_recurse_and_are_cut(spark, monkeypatch):
    rows = corpus(3, bases=2, copies=40)
    want = brute(rows)
    for name, value in {"TILE": 4, "ROUNDS": 1, "FREQUENT_FROM": 2}.items():
        monkeypatch.setattr(jaccard_join, name, value)
    assert run(spark, rows) == want
    monkeypatch.setattr(jaccard_join, "ROUNDS", 3)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 7)
    assert run(spark, rows) == want


def test_empty_table(spark):
    assert run(spark, []) == []


def test_links_connect_and_are_similar(spark):
    rows = corpus(5, bases=3)
    docs = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], SCHEMA)
    _, links = jaccard_join.join(docs)
    sets = {d: plain_set(t) for d, t in rows}
    links = links.collect()
    assert links and all(100 * len(sets[r.a] & sets[r.b]) >= 80 * len(sets[r.a] | sets[r.b]) for r in links)


def test_forest():
    rnd = random.Random(1)
    for _ in range(30):
        sets = [np.unique(np.array([rnd.randrange(40) for _ in range(rnd.randint(1, 30))], np.uint64)) for _ in range(25)]
        groups = [rnd.randrange(25) for _ in range(25)]
        found = jaccard_join.forest(sets, list(range(25)), groups)
        parent = list(range(25))

        def root(i):
            while parent[i] != i:
                i = parent[i]
            return i

        def unite(pairs):
            parent[:] = range(25)
            for a, b in pairs:
                parent[max(root(a), root(b))] = min(root(a), root(b))
            return [root(i) for i in range(25)]

        same_group = [(i, j) for i in range(25) for j in range(i) if groups[i] == groups[j]]
        similar = [(i, j) for i in range(25) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))]
        assert unite(same_group + found) == unite(same_group + similar)
        assert len(found) < 25


def test_prefix_is_enough():
    for n in range(1, 200):
        least = min(k for k in range(n + 1) if jaccard_join.linked(k, n, k) and k <= n)
        assert jaccard_join.prefix_length(n) == n - least + 1


def test_shingle_hashes_follow_the_sets():
    texts = [t for _, t in EDGES if t is not None][:10] + [t for _, t in corpus(7, 2, 3)]
    assert [len(s) for s in shingles.shingle_sets(texts)] == [len(plain_set(t)) for t in texts]
    a, b = shingles.shingle_sets(["a b c d e f", "B C D E F"])
    assert len(np.intersect1d(a, b)) == 1


def test_components(spark):
    rnd = random.Random(9)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(64)] + [(2000, 2000)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        ra, rb = root(a), root(b)
        parent[max(ra, rb)] = min(ra, rb)
    want = {x: root(x) for a, b in links if a != b for x in (a, b)}
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark, tables):
    sf = "/root/testdata/sf0.001"
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in op3_jaccard_join(spark, sf).collect()), key=str)
    assert got == brute([(d["doc_id"], d["text"]) for d in tables("documents", sf)])
