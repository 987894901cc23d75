"""Session construction and lineage helpers.

Library functions never create a session themselves: every operator takes
DataFrames and returns DataFrames.  ``get_spark`` is for scripts, tests and
the bench; on a cluster the session comes from the launcher and only the
checkpoint helper below is used.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the operators are designed around.  AQE re-plans joins at runtime
# (broadcast only when the *measured* side is small, split skewed partitions of
# a sort-merge join) and coalesces small shuffle partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    # A join whose output partitioning feeds the next keyed step directly
    # (semi join on customer, then the per-customer aggregation) is otherwise
    # never split: splitting would break that partitioning.  Forcing the split
    # adds one shuffle of partially aggregated rows, and only when a hot key
    # was measured.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static broadcast only below 32 MB of *estimated* size; above that the
    # planner falls back to a shuffle join, and AQE may still broadcast once
    # the real size of the shuffled side is known.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "martlake",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    ``shuffle_partitions`` defaults to the core count in local mode; on a
    cluster it should be sized so one partition holds ~128 MB of shuffle data
    (AQE coalesces downwards from there).
    """
    master = master or os.environ.get("MARTLAKE_MASTER", "local[*]")
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(SCALE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.driver.memory"] = os.environ.get("MARTLAKE_DRIVER_MEMORY", "16g")
    if shuffle_partitions is None:
        shuffle_partitions = os.cpu_count() or 8
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is used as is.  Only when nothing is configured (tests, local runs) a
    fresh temporary folder is created.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        current = tempfile.mkdtemp(prefix="martlake-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", current)
        except Exception:  # noqa: BLE001 - some sessions refuse core settings at runtime
            pass
    spark.sparkContext.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Used where a plan is consumed by an iterative algorithm or several heavy
    consumers; the data survives the loss of the executors that computed it.
    A reliable checkpoint writes its files in a second job over the same
    data, so the input is persisted for the duration of the checkpoint and
    released right after: the plan runs once, not twice.
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()
