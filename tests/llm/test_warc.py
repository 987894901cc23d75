from __future__ import annotations

import base64
import glob
import hashlib
import io
import random
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from martlake.llm import queries, warc
from tests.llm.conftest import SF

SCHEMA = "page_id long, url string, html string, record_type string"
ROWS = [
    (1, "http://a.example/x", "<p>same</p>", "clash"),
    (2, None, "<p>same</p>", None),
    (9, "http://a.example/\r\nWARC-Type: evil é", "<p>same</p>", None),
    (3, "http://b.example/", None, None),
    (4, "", "", None),
    (5, "http://c.example/", "é" * 50_000, None),
    (5, "http://c.example/", "é" * 50_000, None),
    (None, "http://d.example/", "<p>same</p>", None),
    (None, None, "alone", None),
    (6, "http://e.example/", "a\r\n\r\nWARC/1.1\r\n", None),
]


def expected(rows, min_bytes=0):
    payloads = [((r[2] or "").encode(), r) for r in rows]
    largest = {}
    for p, r in payloads:
        if r[0] is not None and len(p) >= min_bytes:
            largest[p] = max(largest.get(p, r[0]), r[0])
    out = []
    for p, r in payloads:
        head = largest.get(p)
        revisit = head is not None and head != r[0]
        out.append((r[0], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", head if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("min_bytes", [0, 1, 20])
def test_round_trip(spark, tmp_path, min_bytes):
    pages = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    warc.write(warc.with_record_types(pages, min_bytes), str(tmp_path / "w"))
    got = warc.valid(warc.read(spark, str(tmp_path / "w"))).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(ROWS, min_bytes)
    by = {(r.page_id, r.url): r for r in got}
    assert bytes(by[(6, "http://e.example/")].payload) == b"a\r\n\r\nWARC/1.1\r\n"
    assert by[(9, "http://a.example/%0D%0AWARC-Type:%20evil%20%C3%A9")].record_type == "response"


def test_archives_are_zstandard_streams_with_a_dictionary_in_front(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "<p>text</p>" * i, None) for i in range(300)], SCHEMA).coalesce(1)
    warc.write(warc.with_record_types(pages).coalesce(1), str(tmp_path / "w"))
    (path,) = glob.glob(str(tmp_path / "w" / "part-*"))
    raw = open(path, "rb").read()
    assert raw[:4] == bytes.fromhex("5d2a4d18")
    size = int.from_bytes(raw[4:8], "little")
    dictionary = zstandard.ZstdCompressionDict(raw[8 : 8 + size])
    text = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(io.BytesIO(raw[8 + size :]), read_across_frames=True).read()
    assert text.count(b"WARC/1.1\r\n") == 300


def test_archives_end_at_a_size(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, f"http://h/{i}", rng.randbytes(200_000 if i == 50 else 1_000).hex(), None) for i in range(400)]
    limit = 100_000
    warc.write(warc.with_record_types(spark.createDataFrame(rows, SCHEMA)).coalesce(1), str(tmp_path / "w"), limit)
    sizes = [len(open(p, "rb").read()) for p in glob.glob(str(tmp_path / "w" / "part-*"))]
    assert len(sizes) > 5 and sum(n > limit + 5_000 for n in sizes) <= 1  # that of the long page alone
    got = warc.valid(warc.read(spark, str(tmp_path / "w"))).collect()
    assert sorted((r.page_id, bytes(r.payload).decode()) for r in got) == [(i, html) for i, _, html, _ in rows]


def test_broken_records_are_told(spark, tmp_path):
    good = warc.record(1, "http://a/", b"payload", "response", None)
    assert warc.parse_record(good)["payload"] == b"payload"
    for bad in (
        good.replace(b"WARC/1.1", b"WARC/9.9"),
        good.replace(b"Content-Length", b"Content-Size"),
        good[:-2],
        good + b"x",
        good.replace(b"payload\r\n", b"paylaod\r\n"),
        good.replace(b"WARC-Date", b"WARC-Type"),
        good.replace(b"X-Payload-Length: 7", b"X-Payload-Length: 8"),
        good.replace(b"response\r\nWARC-Record", b"metadata\r\nWARC-Record"),
        b"",
    ):
        with pytest.raises(ValueError):
            warc.parse_record(bad)
    compress = zstandard.ZstdCompressor().compress
    broken = compress(good) + compress(good[:-1]) + compress(good)[:-9]
    errors = [r.get("error") for r in warc._records(broken)]
    assert errors[0] is None and "Content-Length" in errors[1] and errors[2] and len(errors) == 3
    folder = tmp_path / "archives"
    folder.mkdir()
    (folder / "one").write_bytes(broken)
    assert warc.read(spark, str(folder)).filter("error is not null").count() == 2
    with pytest.raises(Exception, match="Content-Length"):
        warc.valid(warc.read(spark, str(folder))).collect()


def test_empty_table(spark, tmp_path):
    warc.write(warc.with_record_types(spark.createDataFrame([], SCHEMA)), str(tmp_path / "w"))
    assert warc.valid(warc.read(spark, str(tmp_path / "w"))).count() == 0


def test_reading_takes_time_in_proportion(spark, tmp_path):
    def archive(n: int) -> bytes:
        path = str(tmp_path / str(n))
        rows = spark.range(n).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), "id").alias("url"), F.concat(F.lit("<p>page "), "id").alias("html"))
        warc.write(warc.with_record_types(rows).coalesce(1), path)
        return b"".join(p.read_bytes() for p in sorted((tmp_path / str(n)).glob("part-*")))

    def seconds(data: bytes, n: int) -> float:
        begin = time.process_time()
        assert sum("error" not in r for r in warc._records(data)) == n
        return time.process_time() - begin

    small, large = archive(2_000), archive(32_000)
    assert seconds(large, 32_000) < 40 * max(seconds(small, 2_000), 0.02)


def test_query_follows_its_definition(spark, tables):
    pages = {p["page_id"]: (p["html"] or "").encode() for p in tables("pages")}
    last: dict = {}
    for page_id, payload in pages.items():
        last[payload] = max(page_id, last.get(payload, page_id))
    want = set()
    for page_id, payload in pages.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode().rstrip("=")
        first = last[payload] == page_id
        want.add((page_id, len(payload), digest, "response" if first else "revisit", None if first else last[payload]))
    rows = queries.QUERIES["op1_warc"](spark, SF).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert len(rows) == len(pages) and {tuple(r) for r in rows} == want
