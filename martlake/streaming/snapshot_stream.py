"""Customer history maintained from a stream of deliveries (M5 driven by Structured Streaming).

The original job re-reads the full customer table on a daily schedule and
snapshots it.  Here each delivery (a set of parquet files dropped into a
folder) is one micro-batch: ``readStream`` picks up new files, and
``foreachBatch`` applies the type-2 merge of ``martlake.operators.scd2``.
``trigger(availableNow=True)`` processes what has arrived and stops, which is
the scheduled run; a long-running trigger works the same way.

The history folder is that of ``martlake.sources.history``, which the scheduled
build writes too: append-only, a batch counts once it is committed, and only the
open versions are read and rewritten. The streaming checkpoint records which
files each batch consumed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martlake.sources import history
from martlake.sources.tables import RAW_SCHEMAS, conform


def apply_delivery(
    delivery: DataFrame,
    history_dir: str,
    batch_id: int,
    batch_ts: dt.datetime,
    key: str = "customer_id",
) -> None:
    """Merge one delivery into the history folder (the ``foreachBatch`` body).

    A batch that is run again after it was committed changes nothing.
    """
    spark = delivery.sparkSession
    if batch_id not in dict(history.committed(spark, history_dir)):
        attempt = history.stage(delivery, history_dir, batch_id, batch_ts, key)
        history.commit(spark, history_dir, batch_id, attempt, batch_ts)


def start_snapshot_stream(
    spark: SparkSession,
    incoming_dir: str,
    history_dir: str,
    checkpoint_location: str,
    batch_ts: Callable[[int], dt.datetime],
    schema: T.StructType = RAW_SCHEMAS["raw_customers"],
    key: str = "customer_id",
    available_now: bool = True,
    files_per_delivery: int | None = None,
) -> StreamingQuery:
    """Start the stream; each micro-batch is merged into ``history_dir``.

    ``batch_ts(batch_id)`` gives the validity timestamp of a batch, the same
    one whenever the batch is run again.  With ``files_per_delivery`` (the
    number of files that the producer writes for each delivery) deliveries that
    wait together are still one batch each; without it all waiting files are
    one delivery, and a key in two of them fails the batch.
    ``checkpoint_location`` must be on shared storage on a cluster.
    """
    reader = spark.readStream.schema(schema)
    if files_per_delivery:
        reader = reader.option("maxFilesPerTrigger", files_per_delivery)
    stream = conform(reader.parquet(incoming_dir), schema)

    def each_batch(batch_df: DataFrame, batch_id: int) -> None:
        apply_delivery(batch_df, history_dir, batch_id, batch_ts(batch_id), key)

    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
