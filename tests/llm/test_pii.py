from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from martlake.llm import pii
from martlake.llm.queries import op4_pii

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
SCHEMA = "doc_id long, text string, spans int, candidates string"


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def passes(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True, "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in p.finditer(text or "") if passes(k, m[0])]


def annotated(spark, rows):
    found = pii.with_candidates(spark.createDataFrame(rows, SCHEMA))
    return pii.with_spans(found, pii.fit(found))


TRICKY = [
    None,
    "",
    "a@b.c.+d@e.f",
    "a@b.c_d@e.f x@y @z.com a@b@c.de",
    "1.2.3.4.5.6.7.8 256.1.1.1 0001.002.3.255 1.2.3 .1.2.3.4.",
    "4111 1111 1111 1111, 4111-1111-1111-1112 4111  1111 1111 1111 1 2 34",
    "4337166598464399 " * 3 + "43371665984643990000000 4337166598464399",
    "+1 (988) 555-2485 +12 +1-2 +33 1 23 45 67 89 01 23 45 67 +1 988 555 2485.",
    "é😀 a@b.co 日本 10.0.0.1 ü +49 (30) 1234567",
    "a" * 30_000 + "@" + "b." * 5_000 + "c",
    "9" * 20_000 + " " + "1 " * 9_000 + "+1" + "-" * 20_000,
    "x@y.z" * 500,
]


def test_base_spans_are_the_plain_ones(spark):
    rnd = random.Random(2)
    texts = TRICKY + ["".join(rnd.choice("ab1234@.. -+()_é") for _ in range(rnd.randint(0, 60))) for _ in range(600)]
    texts += ["".join(rnd.choice(["4", "1", " ", "-", ".", "255", "@", "a", "+", "00", "4111111111111111"]) for _ in range(40)) for _ in range(300)]
    rows = annotated(spark, [(i, t, 1, "x") for i, t in enumerate(texts)]).collect()
    for r in rows:
        base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert base == plain(texts[r.doc_id]), texts[r.doc_id]
        order = [(pii.KINDS.index(s.kind), s.start) for s in r.spans]
        assert order == sorted(order)


@pytest.mark.parametrize("long", [pii.LONG, 100])
def test_many_matches_in_long_texts(spark, monkeypatch, long):
    monkeypatch.setattr(pii, "LONG", long)
    rnd = random.Random(7)
    words = ["é😀", "a@b.co", "10.0.0.1", "+1 988 555 2485", "x", "日本", "\n", "4111 1111 1111 1111", "y" * 1500]
    texts = [" ".join(rnd.choice(words[: 9 if i < 3 else 8]) for _ in range(n)) for i, n in enumerate((700, 1500, 64, 2000, 6000))]
    texts += ["a@b.co " * n for n in (63, 64, 65, 128)] + ["x" * 1024, "x" * 1017 + " a@b.co", "x" * 1024 + " a@b.co", "x" * 2048]
    rows = annotated(spark, [(i, t, 1, "x") for i, t in enumerate(texts)])
    for r in rows.select("doc_id", "spans", pii.redacted(F.col("text"), F.col("spans")).alias("out")).collect():
        text = texts[r.doc_id]
        assert [(s.kind, s.start, s.end) for s in r.spans if s.base] == plain(text)
        at, out = 0, []
        for s in sorted(r.spans, key=lambda s: (s.start, s.end)):
            if s.start >= at:
                out.append(text[at : s.start] + f"[{s.kind.upper()}]")
            at = max(at, s.end)
        assert r.out == "".join(out) + text[at:] if r.spans else text


def test_long_disguised_addresses_and_clashing_columns(spark):
    name, labels = "n" * 90, " [dot] ".join(["part"] * 12 + ["d" * 80, "com"])
    text = f"mail {name} [at] {labels} for more"
    docs = spark.createDataFrame([(1, text, 2, "p", "c")], "_base_email long, text string, _row int, _pieces string, CANDIDATES string")
    row = pii.with_candidates(docs).first()
    assert [(c.kind, text[c.start : c.end]) for c in row.candidates] == [("email", f"{name} [at] {labels}")]
    assert (row["_base_email"], row["_row"], row["_pieces"], row["text"]) == (1, 2, "p", text)


def test_other_spans_need_support(spark):
    prose = "write to " + "ann@example.com today. " * 5 + "call +1 (988) 555-2485 now. host 10.1.2.3 up. card 4111 1111 1111 1111 paid. "
    rows = [(i, prose, 0, "") for i in range(40)]
    rows += [(100, "mail bob [at] example [dot] org for more", 0, ""), (101, "call (555) 234-9876 today", 0, ""), (102, "nothing to see here", 0, "")]
    got = {r.doc_id: r for r in annotated(spark, rows).collect()}
    assert [(s.kind, s.base) for s in got[100].spans] == [("email", False)]
    assert [(s.kind, s.base) for s in got[101].spans] == [("phone", False)]
    assert got[102].spans == []
    assert rows[40][1][got[100].spans[0].start : got[100].spans[0].end] == "bob [at] example [dot] org"


def test_reliabilities_are_recovered():
    rnd = random.Random(4)
    rates = [(0.95, 0.1), (0.8, 0.2), (0.7, 0.3), (0.9, 0.05)]
    counts = {}
    for _ in range(40_000):
        truth = rnd.random() < 0.4
        votes = tuple(int(rnd.random() < p[not truth]) for p in rates)
        counts[votes] = counts.get(votes, 0) + 1
    prior, found = pii.expectation_maximisation([(list(v), n) for v, n in counts.items()])
    assert abs(prior - 0.4) < 0.03
    for (p, q), (a, b) in zip(found.values(), rates):
        assert abs(p - a) < 0.04 and abs(q - b) < 0.04


def test_no_candidates_and_empty_table(spark):
    assert [r.spans for r in annotated(spark, [(1, "plain words", 0, "")]).collect()] == [[]]
    assert pii.with_spans(pii.with_candidates(spark.createDataFrame([], SCHEMA)), pii.fit(pii.with_candidates(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_redaction(spark):
    rows = annotated(spark, [(1, "é a@b.co and 10.0.0.1.", 0, ""), (2, "none", 0, ""), (3, "a@b.co", 0, "")])
    got = {r.doc_id: r.out for r in rows.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("out")).collect()}
    assert got == {1: "é [EMAIL] and [IP].", 2: "none", 3: "[EMAIL]"}


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, tables, sf):
    got = {r.doc_id: r for r in op4_pii(spark, sf).collect()}
    for d in tables("documents", sf):
        spans = plain(d["text"])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[d["doc_id"]]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_plan_has_no_python(spark):
    plan = op4_pii(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
