"""Table sources and sinks.

Every raw table has a declared schema; reads ``select`` + ``cast`` to it so a
missing column fails at analysis time, before any task runs, and only the
declared columns reach the parquet ``ReadSchema``.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_customers": T.StructType(
        [
            T.StructField("customer_id", T.LongType()),
            T.StructField("name", T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("city", T.StringType()),
            T.StructField("segment", T.StringType()),
            T.StructField("signup_date", T.DateType()),
        ]
    ),
    "raw_products": T.StructType(
        [
            T.StructField("product_id", T.LongType()),
            T.StructField("product_name", T.StringType()),
            T.StructField("category", T.StringType()),
            T.StructField("price_cents", T.LongType()),
            T.StructField("cost_cents", T.LongType()),
        ]
    ),
    "raw_orders": T.StructType(
        [
            T.StructField("order_id", T.StringType()),
            T.StructField("customer_id", T.LongType()),
            T.StructField("order_date", T.TimestampNTZType()),
            T.StructField("status", T.StringType()),
        ]
    ),
    "raw_order_items": T.StructType(
        [
            T.StructField("order_id", T.StringType()),
            T.StructField("product_id", T.LongType()),
            T.StructField("quantity", T.LongType()),
            T.StructField("amount_cents", T.LongType()),
        ]
    ),
}

DATE_DIMENSION_SCHEMA = T.StructType(
    [
        T.StructField("date_id", T.IntegerType()),
        T.StructField("date_day", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("day_of_week", T.StringType()),
    ]
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the declared columns in order and cast them to the declared types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """Lakehouse table scan.

    ``fmt="delta"`` is passed through to the reader when the Delta package is
    on the classpath; parquet is the default.
    """
    df = spark.read.format(fmt).load(path)
    return conform(df, schema) if schema is not None else df


def register_raw(
    spark: SparkSession,
    base: str,
    fmt: str = "parquet",
    names: Iterable[str] = tuple(RAW_SCHEMAS),
) -> dict[str, DataFrame]:
    """Register each raw table found under ``base`` as a temp view.

    Missing folders are skipped; any other failure raises.
    """
    found: dict[str, DataFrame] = {}
    for name in names:
        path = os.path.join(base, name)
        try:
            df = read_table(spark, path, fmt, RAW_SCHEMAS.get(name))
        except AnalysisException as exc:
            if exc.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        df.createOrReplaceTempView(name)
        found[name] = df
    return found


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """View materialisation (S4): a lazy DataFrame under a name."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] | None = None,
    mode: str = "overwrite",
    balanced: bool = False,
) -> None:
    """Full-overwrite table sink.

    Writing is distributed: each task writes its own files and the commit
    protocol publishes them atomically per job.  Spark cannot overwrite a
    path the same plan reads from; write to a new path instead.

    An input of one large row group or file is read by one task. ``balanced``
    deals its rows anew before they are written, in partitions of the advisory
    size as adaptive execution measures them, so that every core writes.
    """
    if balanced:
        df = df.hint("rebalance")
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType = DATE_DIMENSION_SCHEMA) -> DataFrame:
    """Typed CSV seed scan with a header row."""
    return spark.read.csv(path, header=True, schema=schema, enforceSchema=False)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV export with a header row and no index.

    The plan runs once; files are written by the executors (one per
    partition).  An empty result leaves a file with the header alone.
    """
    df.write.mode("overwrite").option("header", True).csv(path)


def export_all(
    frames: Mapping[str, DataFrame | None], directory: str, schemas: Mapping[str, T.StructType] | None = None
) -> list[str]:
    """Export several results into ``directory/<name>`` (S10); returns the names written.

    A missing input (``None``) becomes an empty dataset of its schema in
    ``schemas``; without one it has no columns to write and is left out.
    """
    written = []
    for name, df in frames.items():
        if df is None and schemas and name in schemas:
            df = SparkSession.active().createDataFrame([], schemas[name])
        if df is not None:
            export_csv(df, os.path.join(directory, name))
            written.append(name)
    return written
