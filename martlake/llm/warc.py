"""WARC archives compressed with Zstandard: one frame per record, dictionary in front.

An archive is a text-file part that Spark writes with its own commit protocol,
so that a lost executor leaves no half archive behind. Its first bytes are a
skippable frame that holds the dictionary (magic number 0x184D2A5D), then one
frame follows for each record. An archive ends where its frames reach a limit of
bytes, so that a partition of any size becomes archives that one task can read.
Spark ends each line with a separator; it is an empty skippable frame here, so
that the file is a valid Zstandard stream and any reader passes over it.

The reader loads the dictionary from the leading frame, decodes frame by frame
and validates versions, header fields, lengths and payload digests.

Defined results: null html counts as empty; null urls give no target header;
control and non-ASCII characters of urls are percent-encoded in the header;
repeated rows give repeated records of one type (the response's row, repeated,
is a response each time); rows with null page_id take no part in choosing the
response and revisit it unless no id is known; an empty table gives an empty
archive and no records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values of the formats
DICTIONARY_MAGIC, SEPARATOR_MAGIC = 0x184D2A5D, 0x184D2A50
FRAME_MAGIC = 0xFD2FB528
VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
SEPARATOR = struct.pack("<II", SEPARATOR_MAGIC, 0).decode("ascii")

DICTIONARY_BYTES = 1 << 15
DICTIONARY_SAMPLES = 200  # records from which an archive's dictionary is made
SAMPLE_BYTES = 1 << 14
ARCHIVE_BYTES = 1 << 25  # an archive ends with the record that reaches this size

RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary, error string"


def with_record_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, record_type and refers_to of all pages.

    Of equal payloads of at least ``min_bytes`` the largest page_id is the
    response. The digests are pre-aggregated before they are shuffled, and a
    payload that a third of all pages share is split by the skew join.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumn("_digest", F.sha1("payload"))
    first = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("_digest").agg(F.max("page_id").alias("_response"), F.count("*").alias("_n"))
    joined = rows.join(first.filter("_n > 1").drop("_n"), "_digest", "left")
    revisit = F.col("_response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    return joined.select(
        "page_id",
        "url",
        "payload",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_response")).alias("refers_to"),
    )


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_urn(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _header_url(url: str) -> str:
    return re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "replace")), url)


def record(page_id: int | None, url: str | None, payload: bytes, record_type: str, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has the full payload's digest and length, and no payload."""
    block = HTTP_HEAD % len(payload) + (payload if record_type == "response" else b"")
    fields = [
        ("WARC-Type", record_type),
        ("WARC-Record-ID", _page_urn(page_id)),
        ("WARC-Date", DATE),
        *([("WARC-Target-URI", _header_url(url))] if url is not None else []),
        *([("WARC-Refers-To", _page_urn(refers_to)), ("WARC-Profile", REVISIT_PROFILE)] if record_type == "revisit" else []),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields and payload of one record; raises ValueError where it is not valid."""
    head, split, rest = raw.partition(b"\r\n\r\n")
    if not split:
        raise ValueError("the header does not end")
    lines = head.decode("utf-8").split("\r\n")
    if lines[0] != VERSION:
        raise ValueError(f"unknown version {lines[0][:20]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip() or name.lower() in fields:
            raise ValueError(f"malformed or repeated header field {line[:40]!r}")
        fields[name.lower()] = value.strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"):
        if name not in fields:
            raise ValueError(f"no field {name}")
    if not fields["content-length"].isdigit() or int(fields["content-length"]) + 4 != len(rest):
        raise ValueError(f"Content-Length {fields['content-length'][:20]} and {len(rest) - 4} bytes of block")
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("the record does not end with two line ends")
    urn = re.fullmatch(r"<urn:x-page:(-?\d*)>", fields["warc-record-id"])
    if not urn:
        raise ValueError("malformed record id")
    kind, stated = fields["warc-type"], fields.get("x-payload-length", "")
    http, split, payload = rest[:-4].partition(b"\r\n\r\n")
    length = re.search(rb"\r\nContent-Length: (\d+)", http)
    if not split or not length or not stated.isdigit() or int(length[1]) != int(stated):
        raise ValueError("the block's header states no length, or another one")
    out = {"page_id": int(urn[1]) if urn[1] else None, "url": fields.get("warc-target-uri"), "payload_bytes": int(stated), "record_type": kind}
    out["payload_digest"] = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        if len(payload) != int(stated) or digest(payload) != out["payload_digest"]:
            raise ValueError("the payload does not have the stated length and digest")
        return out | {"refers_to": None, "payload": payload}
    refers = re.fullmatch(r"<urn:x-page:(-?\d+)>", fields.get("warc-refers-to", ""))
    if kind != "revisit" or payload or not refers:
        raise ValueError(f"unknown type {kind[:20]!r}, or a revisit with a payload or without the record it refers to")
    return out | {"refers_to": int(refers[1]), "payload": None}


def _dictionary(samples: list[bytes]):
    """A dictionary of an archive's first records: trained, or their plain bytes where they are too few."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=3)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES] or b"\0" * 8, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write(records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes ``records`` (see with_record_types) as archives below ``path``.

    Each partition gives archives of about ``archive_bytes`` and a last one of
    what is left; a record is never cut, so a longer one ends its archive.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        def archive() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], ["archive"])

        frames, size, compressor = [], 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, DICTIONARY_SAMPLES):
                rows = [record(**r) for r in batch.slice(at, DICTIONARY_SAMPLES).to_pylist()]
                for i, row in enumerate(rows):
                    if compressor is None:
                        dictionary = _dictionary([r[:SAMPLE_BYTES] for r in rows[i:]])
                        plain = dictionary.as_bytes()
                        frames = [struct.pack("<II", DICTIONARY_MAGIC, len(plain)) + plain]
                        size = len(frames[0])
                        compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True, write_checksum=True)
                    frames.append(compressor.compress(row))
                    size += len(frames[-1])
                    if size >= archive_bytes:
                        yield archive()
                        frames, compressor = [], None
        if frames:
            yield archive()

    order = ["page_id", "url", "payload", "record_type", "refers_to"]
    archives = records.select(order).mapInArrow(run, "archive binary")
    # a row is an archive, and a file holds one row
    archives.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 1).text(path)


WINDOW = 1 << 14  # bytes that are handed to a decompressor at once


def _records(archive: bytes) -> Iterator[dict]:
    """The records of an archive, with ``error`` for those that are not valid."""
    import zstandard

    view, at, decompressor = memoryview(archive), 0, None
    if len(archive) >= 8 and struct.unpack_from("<I", archive)[0] == DICTIONARY_MAGIC:
        size = struct.unpack_from("<I", archive, 4)[0]
        if 8 + size > len(archive):
            yield {"error": "the dictionary frame is cut off"}
            return
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size])))
        at = 8 + size
    decompressor = decompressor or zstandard.ZstdDecompressor()
    while at < len(archive):
        if len(archive) - at < 8:
            yield {"error": f"{len(archive) - at} bytes after the last frame"}
            return
        magic, size = struct.unpack_from("<II", archive, at)
        if magic & 0xFFFFFFF0 == SEPARATOR_MAGIC:  # skippable
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            yield {"error": f"no frame begins at byte {at}"}
            return
        try:
            unit, raw, end = decompressor.decompressobj(), bytearray(), at
            while not unit.eof and end < len(archive):  # what is fed after the frame's end is copied back: windows bound that
                raw += unit.decompress(view[end : end + WINDOW])
                end = min(end + WINDOW, len(archive))
            if not unit.eof:
                raise ValueError("the frame is cut off")
            at = end - len(unit.unused_data)
        except (zstandard.ZstdError, ValueError) as error:
            yield {"error": f"frame at byte {at}: {error}"}
            return
        try:
            yield parse_record(bytes(raw))
        except ValueError as error:
            yield {"error": f"record before byte {at}: {error}"}


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives below ``path``; ``error`` tells what is wrong with a record.

    The rest of an archive after a broken frame can't be found again and is
    told of by one row. An archive is read as a whole by one task; the writer
    bounds its size.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    schema = RECORD_SCHEMA if with_payload else RECORD_SCHEMA.replace("payload binary, ", "")
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        out_schema = pa.schema([(x.split()[0], types[x.split()[1]]) for x in schema.split(", ")])
        for batch in batches:
            for content in batch.column(0):
                rows: list[dict] = []
                for row in _records(content.as_py()):
                    rows.append({k: row.get(k) for k in names})
                    if len(rows) == 256:
                        yield pa.RecordBatch.from_pylist(rows, out_schema)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, out_schema)

    return files.mapInArrow(run, schema)


def valid(records: DataFrame) -> DataFrame:
    """``records`` without ``error``; the job fails on a record that has one."""
    return records.filter(F.when(F.col("error").isNotNull(), F.raise_error(F.col("error")).cast("boolean")).otherwise(True)).drop("error")
