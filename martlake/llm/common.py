"""Helpers that several operators share: stored tables, ranks, text columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.session import ensure_checkpoint_dir

BATCH_ROWS, STORED_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
ROW_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts the lineage: a lost executor costs its running tasks and no more.
    """
    spark = df.sparkSession
    path, rows = scratch_path(spark, name), spark.conf.get(BATCH_ROWS)
    spark.conf.set(BATCH_ROWS, min(int(rows), STORED_BATCH) if int(rows) > 0 else STORED_BATCH)  # for this job: rows may hold long texts
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, rows)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, keys: list, name: str, rank: str = "rank") -> DataFrame:
    """``df`` with its position in the total order of ``keys`` (from 0) as ``rank``.

    One range shuffle and one stored table. What reaches the driver is the row
    count of each partition, and the offsets that come back are as many rows.
    Ties get different ranks, fixed by the stored table.
    """
    pos = "_pos"
    parts = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(pos, F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned(pos, ROW_BITS)
    rows = sorted((r["part"], r["n"]) for r in parts.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for p, n in rows:
        offsets.append((p, total))
        total += n
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    joined = parts.withColumn("_part", part).join(F.broadcast(starts), "_part")  # a row for each partition
    return joined.withColumn(rank, F.col("_start") + (F.col(pos) - F.shiftleft("_part", ROW_BITS))).drop("_part", "_start", pos)


def small_arrow_batches(spark: SparkSession) -> None:
    """Lets the session hand at most STORED_BATCH rows at once to Python workers: rows hold whole texts."""
    rows = int(spark.conf.get(BATCH_ROWS))
    if not 0 < rows <= STORED_BATCH:
        spark.conf.set(BATCH_ROWS, STORED_BATCH)


def text_or_empty(column: str = "text") -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
