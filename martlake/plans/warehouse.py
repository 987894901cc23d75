"""Warehouse assembly (M11) and saved-view parameters.

``Warehouse`` wires the models lazily from four raw DataFrames; nothing runs
until a query result is consumed.  ``build_warehouse`` is the batch job of
the scheduled run: snapshot, models, tables written, checks enforced.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.operators import models, quality, scd2
from martlake.operators.filters import Window, default_cities
from martlake.operators.metrics import date_bounds
from martlake.sources import history
from martlake.sources.tables import RAW_SCHEMAS, read_table, write_table
from martlake.sources.versions import Versions


@dataclass(eq=False)
class Warehouse:
    raw_customers: DataFrame
    raw_products: DataFrame
    raw_orders: DataFrame
    raw_order_items: DataFrame
    snapshot: DataFrame
    margin_mode: str = "correct"

    @classmethod
    def from_raw(
        cls,
        raw: Mapping[str, DataFrame],
        batch_ts: dt.datetime | str,
        previous_snapshot: DataFrame | None = None,
        margin_mode: str = "correct",
    ) -> "Warehouse":
        snap = scd2.snapshot(raw["raw_customers"], "customer_id", batch_ts, previous_snapshot)
        return cls(
            raw["raw_customers"], raw["raw_products"], raw["raw_orders"], raw["raw_order_items"], snap, margin_mode
        )

    # Lazy plans, built on first use and shared by every query of this warehouse.
    @cached_property
    def stg_orders(self) -> DataFrame:
        return models.stg_orders(self.raw_orders)

    @cached_property
    def fct_orders(self) -> DataFrame:
        return models.fct_orders(self.stg_orders, self.raw_order_items)

    @cached_property
    def dim_products(self) -> DataFrame:
        return models.dim_products(self.raw_products, self.margin_mode)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return models.dim_customers(self.snapshot)

    def check_models(self) -> dict[str, DataFrame]:
        """Models as the checks see them; uniqueness of customers is over current rows (D3)."""
        return {
            "stg_orders": self.stg_orders,
            "dim_customers": self.dim_customers.where(F.col("is_current")),
            "dim_products": self.dim_products,
            "fct_orders": self.fct_orders,
        }

    def quality_report(self, checks: Sequence[quality.Check] = quality.WAREHOUSE_CHECKS) -> DataFrame:
        return quality.quality_report(self.check_models(), checks)


@dataclass(eq=False)
class Marts:
    """Materialised marts read back from parquet, as the dashboard queries see them.

    The original dashboard reads tables built once by the warehouse run; the
    same holds here: the fact is written once, then every dashboard query
    scans it with predicate pushdown and column pruning instead of rebuilding
    it from raw items and orders.
    """

    fct_orders: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    raw_order_items: DataFrame
    path: str
    order_products: DataFrame | None = None

    def check_models(self, stg_orders: DataFrame) -> dict[str, DataFrame]:
        return {
            "stg_orders": stg_orders,
            "dim_customers": self.dim_customers.where(F.col("is_current")),
            "dim_products": self.dim_products,
            "fct_orders": self.fct_orders,
        }


def write_by_date(df: DataFrame, path: str, unique_key: tuple[str, ...] = ("order_id",)) -> None:
    """Write a fact so date windows skip most of it.

    Rows are dealt by month and measured: adaptive execution splits a month that
    is larger than a file should be and puts small ones together, without the
    job that samples a range.  Sorting inside each partition gives row groups
    tight min/max statistics, so the window predicate pushed into the scan skips
    row groups outside **W**.
    """
    by_month = df.withColumn("_month", F.trunc("order_date", "month")).hint("rebalance", "_month").drop("_month")
    by_month.sortWithinPartitions("order_date", *unique_key).write.mode("overwrite").parquet(path)


def write_order_marts(stg_orders: DataFrame, raw_order_items: DataFrame, path: str) -> None:
    """Write the order fact and the (order, product) mart below ``path``.

    Items are read and shuffled once: their sums by order and product are kept
    (on the executors' disks, so that the sorts have the memory; a lost executor's
    part is made again) while the order totals and the mart's rows are taken from them.
    """
    spark = stg_orders.sparkSession
    pairs = models.order_pairs(raw_order_items).persist(StorageLevel.DISK_ONLY)
    try:
        write_by_date(models.fct_of_totals(stg_orders, models.pair_totals(pairs)), os.path.join(path, "fct_orders"))
        fct = spark.read.parquet(os.path.join(path, "fct_orders"))
        write_by_date(models.order_product_facts(pairs, fct), os.path.join(path, "order_products"), ("order_id", "product_id"))
    finally:
        pairs.unpersist()


def _together(*jobs: Callable[[], None]) -> None:
    """Runs independent jobs side by side, so that small ones fill the cores that others leave; the first error is raised."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for job in [pool.submit(job) for job in jobs]:
            job.result()


def materialize_marts(wh: "Warehouse", path: str) -> Marts:
    """Write the marts under ``path`` once and return them read back."""
    _together(
        lambda: write_order_marts(wh.stg_orders, wh.raw_order_items, path),
        lambda: write_table(wh.dim_customers, os.path.join(path, "dim_customers")),
        lambda: write_table(wh.dim_products, os.path.join(path, "dim_products")),
    )
    return _read_folder(wh.raw_orders.sparkSession, path, wh.raw_order_items)


def _read_folder(spark: SparkSession, path: str, raw_order_items: DataFrame, dim_customers: DataFrame | None = None) -> Marts:
    read = lambda name: spark.read.parquet(os.path.join(path, name))
    return Marts(
        fct_orders=read("fct_orders"),
        dim_customers=read("dim_customers") if dim_customers is None else dim_customers,
        dim_products=read("dim_products"),
        raw_order_items=raw_order_items,
        path=path,
        order_products=read("order_products"),
    )


def published_marts(wh: "Warehouse", root: str) -> Marts:
    """The marts published below ``root``; written and published first where there are none."""
    spark = wh.raw_orders.sparkSession
    found = read_marts(spark, root, wh.raw_order_items)
    if found is None:
        versions = Versions(spark, root)
        version = versions.new()
        materialize_marts(wh, versions.folder(version))
        versions.publish(version, ["dim_customers", "dim_products", "fct_orders", "order_products"])
        found = read_marts(spark, root, wh.raw_order_items)
    return found


def read_marts(spark: SparkSession, marts_dir: str, raw_order_items: DataFrame) -> Marts | None:
    """The marts published last below ``marts_dir`` (``<out_dir>/marts`` of a scheduled build); None where there are none."""
    versions = Versions(spark, marts_dir)
    manifest = versions.current()
    if manifest is None:
        return None
    about, dim = manifest["about"], None
    if "dim_customers" not in manifest["tables"]:
        dim = models.dim_customers(history.read_staged(spark, about["history"], int(about["batch"]), about["attempt"]))
    return _read_folder(spark, versions.folder(manifest["version"]), raw_order_items, dim)


def build_warehouse(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    batch_ts: dt.datetime | str,
    fmt: str = "parquet",
) -> list:
    """Read raw tables, snapshot customers, write the marts, enforce the checks, publish.

    The snapshot is always run (defect D11).  What is written stays unseen until
    the checks have passed:

    * the customers' history in ``<out_dir>/history`` gets an attempt of the next batch,
      which reads and writes the open versions and appends the newly closed ones;
    * the marts go to a new version in ``<out_dir>/marts``; the customer dimension
      is the history as of this batch, so no closed version is copied.

    The checks read both from disk.  Where one fails, ``QualityGateError`` is raised
    and readers keep the former marts and history; otherwise the batch is committed
    and the version published.  Returns the report rows.
    """
    raw = {name: read_table(spark, os.path.join(raw_dir, name), fmt, schema) for name, schema in RAW_SCHEMAS.items()}
    history_dir = os.path.join(out_dir, "history")
    last = history.latest_batch(spark, history_dir)
    batch = 0 if last is None else last + 1
    attempt = history.stage(raw["raw_customers"], history_dir, batch, batch_ts)
    dim_customers = models.dim_customers(history.read_staged(spark, history_dir, batch, attempt))

    versions = Versions(spark, os.path.join(out_dir, "marts"))
    version = versions.new()
    path = versions.folder(version)
    stg_orders = models.stg_orders(raw["raw_orders"])
    _together(
        lambda: write_order_marts(stg_orders, raw["raw_order_items"], path),
        lambda: write_table(models.dim_products(raw["raw_products"]), os.path.join(path, "dim_products")),
    )
    marts = _read_folder(spark, path, raw["raw_order_items"], dim_customers)
    report = quality.enforce(quality.quality_report(marts.check_models(stg_orders), quality.WAREHOUSE_CHECKS))

    history.commit(spark, history_dir, batch, attempt, batch_ts)
    about = {"history": history_dir, "batch": str(batch), "attempt": attempt}
    versions.publish(version, ["dim_products", "fct_orders", "order_products"], about)
    return report


def resolve_view_params(
    fct: DataFrame, dim: DataFrame, params: Mapping[str, object] | None = None
) -> Window:
    """Saved-view parameters or defaults.

    ``start``/``end`` default to the fact's first/last order date (G11);
    ``cities`` keeps the requested ones that exist, else the first five by
    name (F7).  Only bounded results reach the driver: one row of bounds and
    at most the requested/five city names.  An empty fact leaves bounds that
    are not given open (None).
    """
    params = dict(params or {})
    start, end = params.get("start"), params.get("end")
    if not start or not end:
        row = date_bounds(fct).first()
        start = start or row["min_date"]
        end = end or row["max_date"]
    requested = params.get("cities") or None
    if isinstance(requested, str):
        requested = [requested]
    cities = [r["city"] for r in default_cities(dim, requested).collect()]
    return Window.of(start, end, cities)
