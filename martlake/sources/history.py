"""Type-2 history as an append-only folder, for the scheduled build and the stream (M5).

Layout::

    <history>/batch=<n>/attempt=<id>/state=closed/   versions that this batch closed
    <history>/batch=<n>/attempt=<id>/state=open/     every open version after this batch
    <history>/_commits/                              a row for each completed batch

The history is all ``closed`` folders of committed batches and the ``open`` folder
of the last one. A batch reads and rewrites the open set alone (one row for each key)
and appends what it closes; closed versions are neither read for the merge nor
written again. A batch counts once it is in ``_commits``: one that is run again
writes a new attempt, and what failed attempts left is never read. Where two
attempts of a batch were committed, the first one counts.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators import scd2
from martlake.sources.folders import remove

COMMIT = "batch long, attempt string, batch_ts timestamp_ntz, committed_at timestamp_ntz"


def _commits_path(history_dir: str) -> str:
    # A leading underscore hides the folder from partition discovery of the history.
    return os.path.join(history_dir, "_commits")


def committed(spark: SparkSession, history_dir: str, before_batch: int | None = None) -> list[tuple[int, str]]:
    """(batch, attempt) of the completed batches below ``before_batch``, in order: a row for each batch."""
    try:
        commits = spark.read.schema(COMMIT).parquet(_commits_path(history_dir))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []  # no batch committed yet
    if before_batch is not None:
        commits = commits.where(F.col("batch") < before_batch)
    first = F.min(F.struct("committed_at", "attempt"))["attempt"].alias("attempt")
    return [(r["batch"], r["attempt"]) for r in commits.groupBy("batch").agg(first).orderBy("batch").collect()]


def latest_batch(spark: SparkSession, history_dir: str, before_batch: int | None = None) -> int | None:
    """The last completed batch (below ``before_batch``)."""
    return max((batch for batch, _ in committed(spark, history_dir, before_batch)), default=None)


def _rows(spark: SparkSession, history_dir: str, condition) -> DataFrame:
    """History rows of the folders that ``condition`` on the partition columns selects."""
    return spark.read.parquet(history_dir).where(condition).drop("batch", "attempt", "state")


def _as_of(attempts: list[str]) -> "F.Column":
    return F.col("attempt").isin(attempts) & ((F.col("state") == "closed") | (F.col("attempt") == attempts[-1]))


def read_history(spark: SparkSession, history_dir: str, before_batch: int | None = None) -> DataFrame | None:
    """The whole history as of the last completed batch (below ``before_batch``)."""
    batches = committed(spark, history_dir, before_batch)
    return _rows(spark, history_dir, _as_of([a for _, a in batches])) if batches else None


def read_open(spark: SparkSession, history_dir: str, before_batch: int | None = None) -> DataFrame | None:
    """The open versions after the last completed batch; no closed folder is read."""
    batches = committed(spark, history_dir, before_batch)
    return _rows(spark, history_dir, (F.col("attempt") == batches[-1][1]) & (F.col("state") == "open")) if batches else None


def read_staged(spark: SparkSession, history_dir: str, batch: int, attempt: str) -> DataFrame:
    """The whole history as it is once ``attempt`` of ``batch`` is committed."""
    return _rows(spark, history_dir, _as_of([a for _, a in committed(spark, history_dir, batch)] + [attempt]))


def stage(delivery: DataFrame, history_dir: str, batch: int, batch_ts: dt.datetime | str, key: str = "customer_id") -> str:
    """Merges a delivery into the open versions; returns the attempt that was written, not yet committed."""
    open_rows = read_open(delivery.sparkSession, history_dir, batch)
    if open_rows is None:
        rows = scd2.snapshot(delivery, key, batch_ts)
    else:
        rows = scd2.merge_open_rows(open_rows.select(*delivery.columns, *scd2.SCD_COLUMNS), delivery, key, batch_ts)
    state = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit("closed"))
    attempt = f"a{uuid.uuid4().hex}"  # no number, which partition discovery would read as one
    # one job writes both states
    rows.withColumn("state", state).write.partitionBy("state").parquet(os.path.join(history_dir, f"batch={batch}", f"attempt={attempt}"))
    return attempt


def commit(spark: SparkSession, history_dir: str, batch: int, attempt: str, batch_ts: dt.datetime | str) -> None:
    """Completes a batch; fails where another attempt of it was committed before."""
    if isinstance(batch_ts, str):
        batch_ts = dt.datetime.fromisoformat(batch_ts)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    spark.createDataFrame([(batch, attempt, batch_ts, now)], COMMIT).write.mode("append").parquet(_commits_path(history_dir))
    if (batch, attempt) not in committed(spark, history_dir):
        raise RuntimeError(f"another run has committed batch {batch} of {history_dir}")


def expire_open(spark: SparkSession, history_dir: str, keep: int = 2) -> list[int]:
    """Removes the open sets of all but the last ``keep`` batches; returns those batches.

    No later batch reads them. What is lost is ``read_history`` as of those batches.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    gone = committed(spark, history_dir)[:-keep]
    return [batch for batch, attempt in gone if remove(spark, os.path.join(history_dir, f"batch={batch}", f"attempt={attempt}", "state=open"))]
