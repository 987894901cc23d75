"""Token counts with a cache of digests.

A count depends on the tokenizer and on the text as the tokenizer normalises
it. So counts are stored under two digests, that of the tokenizer (library,
release and file) and that of the normalised text, and a text that was counted
once, in whatever table, isn't encoded again:

1. Tasks normalise texts and hand on digests; texts stay where they are.
2. The distinct digests meet the stored counts of this tokenizer in a join.
3. Where some are missing, a second pass takes one text for each missing digest
   to the task that encodes it. A task hands on a repeated text once, so that
   copies, however many, are few when they are shuffled.
4. The new counts are appended to the cache, and rows look theirs up by digest
   (hot digests salted).

The cache is a folder of Parquet files, ``tokenizer=<digest>/batch=<id>``. Each
run appends a batch of its own, so runs don't disturb one another. Rows are
facts that hold forever: a batch that was cut short by a lost driver only leaves
digests to be encoded later, and a digest in two batches has the same count.

Defined results: null texts count as empty; rows that repeat each get their
count; columns named like the added ones give way to them; an empty table gives
an empty table and appends nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.llm.common import stored, text_or_empty
from martlake.llm.flat import chunks, kept, small_batches
from martlake.operators.joins import salted_lookup_join

DIGEST = "_digest"
COUNTS = T.StructType([T.StructField(DIGEST, T.BinaryType()), T.StructField("n_tokens", T.LongType())])
REMEMBERED = 100_000  # digests that a task remembers to have handed on


class Tokenizer:
    """A tokenizer file and its library: ``.model`` for sentencepiece, ``.json`` for tokenizers."""

    def __init__(self, path: str) -> None:
        if path.endswith(".model"):
            import sentencepiece as library

            self.model = library.SentencePieceProcessor(model_file=path)
            self.counts = lambda texts: [len(ids) for ids in self.model.encode(texts, num_threads=1)]
            self.normalised = self.model.normalize
        elif path.endswith(".json"):
            import tokenizers as library

            self.model = library.Tokenizer.from_file(path)
            self.model.no_truncation()
            self.model.no_padding()
            self.counts = lambda texts: [len(e) for e in self.model.encode_batch(texts, add_special_tokens=False)]
            # this library looks for special strings before it normalises, so that equal normal forms may count differently
            self.normalised = lambda texts: texts
        else:
            raise ValueError(f"no library for {path}")
        with open(path, "rb") as f:
            content = f.read()
        self.version = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode() + content).hexdigest()

    def digests(self, texts: list[str]) -> list[bytes]:
        return [hashlib.sha256(t.encode()).digest() for t in self.normalised(texts)]


def _tokenizer(path: str) -> Tokenizer:
    return kept(("token_counts", path), lambda: Tokenizer(path))


def with_digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes and the digest of the normalised text in place of the text."""
    others = [c for c in docs.columns if c.lower() not in {text.lower(), "n_bytes", DIGEST, "n_tokens"}]
    whole = text_or_empty(text)
    rows = docs.select(*[F.col(f"`{c}`") for c in others], F.octet_length(whole).cast("long").alias("n_bytes"), whole.alias(DIGEST))
    schema = T.StructType([*rows.schema.fields[:-1], COUNTS[DIGEST]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in small_batches(batches):
            digests = pa.array(tokenizer.digests(batch.column(batch.num_columns - 1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], digests], schema.names)

    return rows.mapInArrow(run, schema)


def _texts(docs: DataFrame, path: str, text: str) -> DataFrame:
    """Digests and texts, a repeated text (nearly) once for each task."""
    schema = T.StructType([COUNTS[DIGEST], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, seen = _tokenizer(path), set()
        for batch in small_batches(batches):
            digests = tokenizer.digests(batch.column(0).to_pylist())
            new = []
            for i, digest in enumerate(digests):
                if digest not in seen:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(digest)
                    new.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([digests[i] for i in new], pa.binary()), batch.column(0).take(pa.array(new, pa.int64()))], schema.names)

    return docs.select(text_or_empty(text).alias("text")).mapInArrow(run, schema)


def _encoded(texts: DataFrame, path: str) -> DataFrame:
    """The counts of ``texts``, by the library."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in small_batches(batches):
            strings = batch.column(1).to_pylist()
            for a, b in chunks(strings):
                counts = pa.array(tokenizer.counts(strings[a:b]), pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), counts], COUNTS.names)

    return texts.mapInArrow(run, COUNTS)


class Cache:
    """Stored counts of one tokenizer below a shared folder."""

    def __init__(self, spark: SparkSession, folder: str, version: str) -> None:
        self.spark, self.path = spark, f"{folder.rstrip('/')}/tokenizer={version}"

    def read(self) -> DataFrame:
        """All stored counts; a digest may be there more than once."""
        try:
            return self.spark.read.schema(COUNTS).parquet(self.path).select(*COUNTS.names)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], COUNTS)

    def append(self, counts: DataFrame) -> DataFrame:
        """Writes a batch of counts and returns it as read back."""
        batch = f"{self.path}/batch={uuid.uuid4().hex}"
        counts.write.parquet(batch)
        return self.spark.read.schema(COUNTS).parquet(batch)


def with_token_counts(docs: DataFrame, path: str, cache_folder: str, text: str = "text") -> DataFrame:
    """``docs`` with n_bytes (UTF-8) and n_tokens in place of the text.

    Counts of the tokenizer at ``path`` that are in ``cache_folder`` are taken
    from there; the others are encoded, once for each distinct normalised text,
    and appended. The folder has to be shared by driver and executors.
    """
    cache = Cache(docs.sparkSession, cache_folder, Tokenizer(path).version)
    keyed = stored(with_digests(docs, path, text), "token-digests")
    wanted = keyed.select(DIGEST).distinct()
    known = cache.read().join(wanted, DIGEST, "left_semi").groupBy(DIGEST).agg(F.max("n_tokens").alias("n_tokens"))
    known = stored(known, "token-counts-known")
    missing = stored(wanted.join(known, DIGEST, "left_anti"), "token-digests-missing")
    counts = known
    if not missing.isEmpty():
        texts = _texts(docs, path, text).join(missing, DIGEST, "left_semi").groupBy(DIGEST).agg(F.first("text").alias("text"))
        counts = known.unionByName(cache.append(_encoded(texts, path)))
    return salted_lookup_join(keyed, counts, DIGEST).drop(DIGEST)
