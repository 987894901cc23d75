from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer as Library

from martlake.llm import packing
from martlake.llm.queries import op7_best_fit_packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a", " ", "  ", "a  b", "\n\nx", "x\n", " \n a", "it's", "it''s", "'s", " 's", "we'll've'd", "I'LL", "'", "''", "'re'", "x'r", "日本 a's", "<|endoftext|>x", "\x1c a", "a\x85b", "\xa0 x", " \xa0x", "'\n's", "é²½"]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(PATH)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [0]


def test_tokenizer_like_the_library(library):
    tokenizer = packing.Tokenizer(PATH)
    rnd = random.Random(3)
    texts = TEXTS + ["".join(rnd.choice("abst're'lvm d'  \n\t.,!é1²ñ") for _ in range(rnd.randint(0, 120))) for _ in range(1500)]
    texts += [f"a{chr(c)}b {chr(c)} {chr(c)}{chr(c)}1{chr(c)}." for c in range(0, 0x3000, 3)]
    ids, at = tokenizer.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def reference_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = min((g for g in gaps if g >= n), default=None)
        if fit is None:
            gaps.append(capacity - n)
        else:
            gaps.remove(fit)
            gaps.append(fit - n)
    return len(gaps)


def layout(plan, counts):
    """Places of all ranks under a plan."""
    total, out = sum(counts.values()), []
    for k, (rank, sequence, each, offset, length) in enumerate(plan):
        end = plan[k + 1][0] if k + 1 < len(plan) else total
        out += [(sequence + (r - rank) // each, offset + (r - rank) % each * length, length) for r in range(rank, end)]
    return out


def test_best_fit_is_one_document_at_a_time_best_fit():
    rnd = random.Random(1)
    for trial in range(150):
        capacity = rnd.choice([7, 16, 100])
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(0, 120))]
        counts = Counter(lengths)
        places = layout(packing.best_fit(counts, capacity), counts)
        assert sorted(n for *_, n in places) == sorted(lengths)
        held = defaultdict(list)
        for s, o, n in places:
            held[s].append((o, n))
        for parts in held.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= capacity
        assert sorted(held) == list(range(len(held)))
        assert len(held) == reference_best_fit(lengths, capacity)


def check_table(got, docs, library, capacity):
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for doc_id, texts in docs.items():
        want = []
        for text in texts:
            ids = ids_of(library, text)
            cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
            want += [(k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in by[doc_id]) == sorted(want)
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(sequences)


def test_tables(spark, library):
    rows = [(2**60 + 1, None, 1), (None, "no id", 2), (3, "", 3), (3, "same", 3), (3, "same", 3), (4, "long text " * 3000, 4), (5, "it's 日本", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int")
    want = defaultdict(list)
    for doc_id, text, _ in rows:
        want[doc_id].append(text)
    got = packing.pack(packing.pieces(docs, PATH, capacity=64), capacity=64).collect()
    check_table(got, want, library, 64)
    assert packing.pack(packing.pieces(docs.limit(0), PATH)).count() == 0


def test_query(spark, tables, library):
    got = op7_best_fit_packing(spark, "/root/testdata/sf0.001").collect()
    docs = {d["doc_id"]: [d["text"]] for d in tables("documents", "/root/testdata/sf0.001")}
    used = check_table(got, docs, library, packing.CAPACITY)
    assert used == reference_best_fit([r.length for r in got], packing.CAPACITY)
