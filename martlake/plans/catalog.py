"""Named queries over the driver's test tables, one per operator of SURVEY section 2.

Every query reads the whole driver tables through the fixed mapping in
``martlake.sources.testdata``; the analysis window below is a parameter of
the dashboard queries (the feature), not a sample.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import os
import uuid
from collections.abc import Callable
from functools import lru_cache, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.functions.dates import date_dimension, week_start
from martlake.functions.labels import cell_label, currency_label, euro_2dp_label, grouped_int_label, percent_label
from martlake.operators import cohort, forecast, metrics, models, quality, scd2, segments
from martlake.operators.filters import (
    Window,
    city_list,
    current_dimension,
    date_window,
    default_cities,
    split_by_tag,
)
from martlake.plans import sql_views
from martlake.plans.warehouse import Marts, Warehouse, build_warehouse, published_marts, resolve_view_params
from martlake.session import cut_lineage, ensure_checkpoint_dir
from martlake.sources import history, tables, testdata
from martlake.sources.versions import Versions

# Fixed parameters of the registered queries (FIXTURES.md section 3).
BATCH_1 = dt.datetime(2024, 1, 1)
BATCH_2 = dt.datetime(2024, 2, 1)
W = Window.of("1996-01-01", "2000-12-31", [f"NATION_{i}" for i in range(10)])
W_ALL = Window.of("1900-01-01", "2100-12-31")
W_QUARTERS = Window.of("1997-01-06", "1997-09-07")  # 35 weeks: the automatic season is 13
W_SHORT = Window.of("1997-01-06", "1997-06-29")  # 25 weeks: the automatic season is 12
DRILL_COHORT, DRILL_MONTH = "1995-01", 14
DRILL_WINDOWED = ("1996-03", 2)
RFM_K = 4
# start centres of the checked k-means: (recency, frequency, monetary), standardised
RFM_START = ((-0.5, 1.5, 1.5), (-0.5, 0.25, 0.0), (-0.25, -0.5, -0.75), (2.0, -1.0, -1.0))
DECAY_N = 6
TOP_N = 100
HW_FIXED = (0.3, 0.1, 0.2)  # smoothing parameters of the checked forecast
MART_LAYOUT = 2  # changes with the columns or the layout of the marts

Query = Callable[[SparkSession, str], DataFrame]


@lru_cache(maxsize=16)
def warehouse(spark: SparkSession, sf_dir: str, margin_mode: str = "correct") -> Warehouse:
    """Lazy warehouse over the driver tables, built once per session and folder.

    Only the unevaluated plans are memoised (like a dashboard keeping its
    views registered); every query still reads the parquet files when it runs.
    """
    return Warehouse.from_raw(testdata.raw_tables(spark, sf_dir), BATCH_1, margin_mode=margin_mode)


@lru_cache(maxsize=16)
def second_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    incoming = testdata.second_customer_load(wh.raw_customers)
    return scd2.snapshot(incoming, "customer_id", BATCH_2, previous=wh.snapshot)


@lru_cache(maxsize=16)
def history_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.dim_customers(second_snapshot(spark, sf_dir))


def _listing(spark: SparkSession, sf_dir: str) -> str:
    """Fingerprint of the raw files: paths, times and sizes, not their contents. One row reaches the driver."""
    paths = [f"{sf_dir}/{name}.parquet" for name in testdata.TABLES]
    files = spark.read.format("binaryFile").load(paths).select("path", "modificationTime", "length")
    hashes = [F.xxhash64(F.lit(seed), "path", F.col("modificationTime").cast("long"), "length") for seed in (0, 1)]
    row = files.agg(F.count("*"), F.sum("length"), F.max("modificationTime").cast("string"), *[F.bit_xor(h) for h in hashes]).first()
    return hashlib.md5(repr((MART_LAYOUT, sf_dir, *row)).encode()).hexdigest()


def marts(spark: SparkSession, sf_dir: str) -> Marts:
    """The marts of the raw files as they are now, below the shared checkpoint folder.

    Dashboard queries read these tables, as the original dashboard reads the
    tables of the warehouse run; the model queries above still build from raw.
    The folder is named after the raw files, so that every session reads one
    copy and changed files get new marts; marts that were not written to the end
    are not published, and written again.
    """
    return _marts(spark, sf_dir, _listing(spark, sf_dir))


@lru_cache(maxsize=16)
def _marts(spark: SparkSession, sf_dir: str, listing: str) -> Marts:
    return published_marts(warehouse(spark, sf_dir), os.path.join(ensure_checkpoint_dir(spark), "martlake-marts", listing))


def _wh_query(fn: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(warehouse(spark, sf_dir))


def _mart_query(fn: Callable[[Marts], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(marts(spark, sf_dir))


def _cohort(wh: Warehouse | Marts, window: Window = W) -> DataFrame:
    return cohort.cohort_retention(wh.fct_orders, wh.dim_customers, window)


def _rfm_wide(wh: Warehouse | Marts) -> DataFrame:
    return segments.rfm_wide(wh.fct_orders, wh.dim_customers, W)


@lru_cache(maxsize=16)
def _fitted(spark: SparkSession, sf_dir: str, listing: str) -> tuple[DataFrame, DataFrame]:
    # one fit feeds all outputs of the segmentation; the per-customer table is checkpointed once
    wide = cut_lineage(_rfm_wide(_marts(spark, sf_dir, listing)))
    return wide, cut_lineage(segments.rfm_clusters(segments.rfm_scaled(wide), RFM_K, seed=42))


@lru_cache(maxsize=16)
def _fitted_from_start(spark: SparkSession, sf_dir: str, listing: str) -> DataFrame:
    return cut_lineage(segments.rfm_clusters_from(segments.rfm_scaled(cut_lineage(_rfm_wide(_marts(spark, sf_dir, listing)))), RFM_START))


def _fixed_cluster_query(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_fitted_from_start(spark, sf_dir, _listing(spark, sf_dir)))


def _cluster_query(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: fn(_fitted(spark, sf_dir, _listing(spark, sf_dir))[1])


def _transition_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every segmentation must keep: all customers, and those of each period, are in some cell."""
    wide, clusters = _fitted(spark, sf_dir, _listing(spark, sf_dir))
    counts = segments.transition_counts(clusters, RFM_K)
    rows = segments.transition_shares(clusters).groupBy("cluster_a").agg(F.sum("share").alias("s"))
    parts = [
        counts.select(sum(F.col(f"b{j}") for j in range(RFM_K)).cast("long").alias("customers")),
        rows.select(F.when(F.abs(F.col("s") - 1) > 1e-9, 1).otherwise(0).cast("long").alias("uneven_rows")),
        wide.join(clusters, "customer_id").select(*[(F.col(f"frequency_{p}") > 0).cast("long").alias(f"active_{p}") for p in ("a", "b")]),
    ]
    together = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    return together.agg(*[F.sum(c).alias(c) for c in ("customers", "uneven_rows", "active_a", "active_b")])


def _scratch(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "martlake-scratch", f"{name}-{uuid.uuid4().hex}")


def _written_raw(spark: SparkSession, sf_dir: str) -> str:
    """The folder of the four raw tables, written once for the driver's files as they are now."""
    versions = Versions(spark, os.path.join(ensure_checkpoint_dir(spark), "martlake-raw", _listing(spark, sf_dir)))
    manifest = versions.current()
    if manifest is None:
        version, raw = versions.new(), testdata.raw_tables(spark, sf_dir)
        for name, df in raw.items():
            tables.write_table(df, versions.path(version, name))
        versions.publish(version, list(raw))
        manifest = versions.current()
    return versions.folder(manifest["version"])


def _registered_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.register_raw(spark, _written_raw(spark, sf_dir))
    return spark.sql(
        "SELECT status, count(*) AS items, sum(amount_cents) AS cents, count(DISTINCT customer_id) AS customers "
        "FROM raw_order_items JOIN raw_orders USING (order_id) GROUP BY status"
    )


def _build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a build. Where a check fails, the build publishes nothing and its report says which."""
    out = os.path.join(ensure_checkpoint_dir(spark), "martlake-build", _listing(spark, sf_dir))
    try:
        rows = build_warehouse(spark, _written_raw(spark, sf_dir), out, BATCH_1)
    except quality.QualityGateError as failed:
        rows = failed.rows
    else:
        Versions(spark, os.path.join(out, "marts")).expire()
        history.expire_open(spark, os.path.join(out, "history"))
    return spark.createDataFrame(rows, "check string, model string, column string, failures long, passed boolean")


def _calendar_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _scratch(spark, "calendar")
    tables.export_csv(date_dimension(metrics.date_bounds(marts(spark, sf_dir).fct_orders), "min_date", "max_date"), path)
    return tables.read_seed_csv(spark, path)


def _exported_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, path = marts(spark, sf_dir), _scratch(spark, "export")
    trend = metrics.monthly_trend(m.fct_orders, m.dim_customers, W)
    tables.export_all({"trend": trend, "empty": trend.limit(0), "missing": None}, path, {"missing": trend.schema})
    parts = [spark.read.csv(os.path.join(path, name), header=True, schema=trend.schema, enforceSchema=False) for name in ("trend", "empty", "missing")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _hw_fixed(season: int | None | str, window: Window = W) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = marts(spark, sf_dir)
        weekly = metrics.weekly_revenue(m.fct_orders, m.dim_customers, window)
        out = forecast.holt_winters_fixed(weekly, *HW_FIXED, season=season)
        return out.select("series", "time", *[F.round(c, 2).alias(c) for c in ("revenue", "lower", "upper")], "type", "model")

    return run


def _hw_parameters(season: int | None | str, window: Window) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        m = marts(spark, sf_dir)
        out = forecast.holt_winters_parameters(metrics.weekly_revenue(m.fct_orders, m.dim_customers, window), season=season)
        return out.select("series", "weeks", "season", *[F.round(c, 4).alias(c) for c in ("alpha", "beta", "gamma")], F.round("squared_error", 0).alias("squared_error"))

    return run


def _dq_failing(kind: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        wh = warehouse(spark, sf_dir)
        if kind == "unique":
            return quality.expect_unique(wh.raw_order_items, "order_id")
        if kind == "not_null":
            return quality.expect_not_null(testdata.second_customer_load(wh.raw_customers), "segment")
        if kind == "accepted_values":
            return quality.expect_accepted_values(wh.fct_orders, "status", ["completed", "shipped"])
        if kind == "relationship":
            parent = wh.dim_customers.where(F.col("city").isin(list(W.cities)))
            return quality.expect_relationship(wh.fct_orders, "customer_id", parent, "customer_id")
        if kind == "between":
            return quality.expect_between(wh.fct_orders, "revenue_euro", 0, 100_000)
        raise ValueError(kind)

    return run


def _resolved_params(wh: Warehouse | Marts) -> DataFrame:
    win = resolve_view_params(wh.fct_orders, wh.dim_customers)
    return default_cities(wh.dim_customers, list(win.cities)).select(
        F.lit(win.start).alias("start_date"), F.lit(win.end).alias("end_date"), "city"
    )


def _hw_by_city(m: Marts) -> DataFrame:
    # current customer rows are unique per customer, so one inner join both
    # restricts to the selected cities and brings the city along
    cities = current_dimension(m.dim_customers, W.cities).select("customer_id", "city")
    weekly = (
        m.fct_orders.where(date_window("order_date", W.start, W.end))
        .join(cities, "customer_id")
        .groupBy("city", week_start("order_date").alias("week"))
        .agg(F.sum("revenue_euro").alias("revenue"))
    )
    return forecast.holt_winters_forecast(weekly, keys=["city"], horizon=12)


def _hw_by_city_category(m: Marts) -> DataFrame:
    # item revenue carries the product's category; one series per (city, category)
    cities = current_dimension(m.dim_customers, W.cities).select("customer_id", "city")
    weekly = (
        m.order_products.where(date_window("order_date", W.start, W.end))
        .join(cities, "customer_id")
        .join(m.dim_products.select("product_id", "category"), "product_id")
        .groupBy("city", "category", week_start("order_date").alias("week"))
        .agg((F.sum("amount_cents").cast("double") / F.lit(100.0)).alias("revenue"))
    )
    return forecast.holt_winters_forecast(weekly, keys=["city", "category"], horizon=12)


def _sql(fn: Callable[..., DataFrame], window: Window = W) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sql_views.register_warehouse_views(marts(spark, sf_dir), warehouse(spark, sf_dir))
        return fn(spark, window)

    return run


QUERIES: dict[str, Query] = {
    # Step 1: models
    "stg_orders": _wh_query(lambda wh: wh.stg_orders),
    "order_totals": _wh_query(lambda wh: models.order_totals(wh.raw_order_items)),
    "fct_orders": _wh_query(lambda wh: wh.fct_orders),
    "dim_products": _wh_query(lambda wh: wh.dim_products),
    "dim_products_reference_margin": lambda s, d: warehouse(s, d, "reference").dim_products,
    # Step 2: metrics and parameters
    "kpi": _mart_query(lambda wh: metrics.kpi(wh.fct_orders, wh.dim_customers, W)),
    "kpi_all": _mart_query(lambda wh: metrics.kpi(wh.fct_orders, wh.dim_customers, W_ALL)),
    "monthly_trend": _mart_query(lambda wh: metrics.monthly_trend(wh.fct_orders, wh.dim_customers, W)),
    "monthly_trend_all": _mart_query(lambda wh: metrics.monthly_trend(wh.fct_orders, wh.dim_customers, W_ALL)),
    "weekly_revenue": _mart_query(lambda wh: metrics.weekly_revenue(wh.fct_orders, wh.dim_customers, W)),
    "date_bounds": _mart_query(lambda wh: metrics.date_bounds(wh.fct_orders)),
    "city_list": _mart_query(lambda wh: city_list(wh.dim_customers)),
    "default_cities": _mart_query(lambda wh: default_cities(wh.dim_customers)),
    "resolved_params": _mart_query(_resolved_params),
    # Step 3: quality
    "dq_report": lambda s, d: quality.quality_report(
        marts(s, d).check_models(warehouse(s, d).stg_orders), quality.WAREHOUSE_CHECKS
    ),
    "dq_unique_failures": _dq_failing("unique"),
    "dq_not_null_failures": _dq_failing("not_null"),
    "dq_accepted_values_failures": _dq_failing("accepted_values"),
    "dq_relationship_failures": _dq_failing("relationship"),
    "dq_between_failures": _dq_failing("between"),
    # Step 4: history
    "snapshot_first": _wh_query(lambda wh: wh.snapshot),
    "snapshot_second": second_snapshot,
    "dim_customers": _wh_query(lambda wh: wh.dim_customers),
    "dim_customers_history": history_dim,
    "kpi_history_current": lambda s, d: metrics.kpi(marts(s, d).fct_orders, history_dim(s, d), W_ALL),
    "kpi_history_all_versions": lambda s, d: metrics.kpi(
        marts(s, d).fct_orders, history_dim(s, d), W_ALL, versions="all"
    ),
    # Step 5: cohorts
    "cohort_retention": _mart_query(_cohort),
    "cohort_retention_all": _mart_query(lambda wh: _cohort(wh, W_ALL)),
    "cohort_size": _mart_query(lambda wh: cohort.cohort_size(_cohort(wh))),
    "cohort_matrix": _mart_query(lambda wh: cohort.cohort_matrix(_cohort(wh), W)),
    "cohort_users_matrix": _mart_query(lambda wh: cohort.cohort_users_matrix(_cohort(wh), W)),
    "decay_curves": _mart_query(lambda wh: cohort.decay_curves(_cohort(wh), DECAY_N)),
    "cohort_drilldown": _mart_query(
        lambda wh: cohort.cohort_drilldown(wh.fct_orders, wh.dim_customers, DRILL_COHORT, DRILL_MONTH, W.cities)
    ),
    # Step 6: products
    "top_products": _mart_query(
        lambda m: metrics.top_n_products(
            metrics.product_revenue_from_marts(m.order_products, m.dim_products, m.dim_customers, W), TOP_N
        )
    ),
    "top_products_all": _mart_query(
        lambda m: metrics.top_n_products(
            metrics.product_revenue_from_marts(m.order_products, m.dim_products, m.dim_customers, W_ALL), TOP_N
        )
    ),
    "top_products_raw": _wh_query(
        lambda wh: metrics.top_products(wh.raw_order_items, wh.dim_products, wh.fct_orders, wh.dim_customers, W, TOP_N)
    ),
    "priced_items": _wh_query(lambda wh: metrics.priced_items(wh.raw_order_items, wh.raw_products)),
    # Step 7: linear forecast
    "linear_forecast": _mart_query(
        lambda wh: forecast.linear_forecast(metrics.monthly_trend(wh.fct_orders, wh.dim_customers, W), digits=2)
    ),
    # Step 8: recency / frequency / monetary
    "rfm_snapshot": _mart_query(lambda wh: segments.rfm_long(_rfm_wide(wh))),
    "rfm_aligned": _mart_query(_rfm_wide),
    "rfm_scaled": _mart_query(lambda wh: segments.rfm_scaled(cut_lineage(_rfm_wide(wh)), digits=6)),
    # Step 9: clusters and transitions (from given start centres with SQL; from k-means|| without, but for the totals)
    "rfm_clusters_fixed": _fixed_cluster_query(lambda c: c),
    "rfm_transition_counts_fixed": _fixed_cluster_query(lambda c: segments.transition_counts(c, RFM_K)),
    "rfm_transition_shares_fixed": _fixed_cluster_query(segments.transition_shares),
    "transition_labels_fixed": _fixed_cluster_query(lambda c: segments.transition_labels(segments.transition_shares(c))),
    "rfm_clusters": _cluster_query(lambda c: c),
    "rfm_transition_counts": _cluster_query(lambda c: segments.transition_counts(c, RFM_K)),
    "rfm_transition_shares": _cluster_query(segments.transition_shares),
    "transition_labels": _cluster_query(lambda c: segments.transition_labels(segments.transition_shares(c))),
    "transition_totals": _transition_totals,
    # Step 10: Holt-Winters (searches of long series have no SQL oracle; shorter ones and given parameters do)
    "holt_winters_forecast": _mart_query(
        lambda wh: forecast.holt_winters_forecast(metrics.weekly_revenue(wh.fct_orders, wh.dim_customers, W))
    ),
    "holt_winters_fixed": _hw_fixed("auto"),
    "holt_winters_fixed_trend": _hw_fixed(None),
    "holt_winters_fixed_quarter": _hw_fixed("auto", W_QUARTERS),
    "holt_winters_fixed_short": _hw_fixed("auto", W_SHORT),
    "holt_winters_parameters": _hw_parameters("auto", W_QUARTERS),
    "holt_winters_parameters_trend": _hw_parameters(None, W_ALL),
    "holt_winters_by_city": _mart_query(_hw_by_city),
    "holt_winters_by_city_category": _mart_query(_hw_by_city_category),
    # Step 11: calendar and labels
    "date_dimension": _mart_query(
        lambda wh: date_dimension(metrics.date_bounds(wh.fct_orders), "min_date", "max_date")
    ),
    "currency_labels": _mart_query(
        lambda m: metrics.product_revenue_from_marts(m.order_products, m.dim_products, m.dim_customers, W).select(
            "product_name", "category", currency_label("revenue").alias("label")
        )
    ),
    "kpi_labels": _mart_query(
        lambda wh: metrics.kpi(wh.fct_orders, wh.dim_customers, W).select(
            currency_label("revenue").alias("revenue_label"),
            grouped_int_label("orders").alias("orders_label"),
            euro_2dp_label("aov").alias("aov_label"),
            grouped_int_label("active_customers").alias("customers_label"),
        )
    ),
    "forecast_rows": _mart_query(
        lambda wh: split_by_tag(
            forecast.linear_forecast(metrics.monthly_trend(wh.fct_orders, wh.dim_customers, W_ALL), digits=2), "Forecast"
        )
    ),
    "weekly_revenue_all": _mart_query(lambda wh: metrics.weekly_revenue(wh.fct_orders, wh.dim_customers, W_ALL)),
    "monthly_trend_history_all_versions": lambda s, d: metrics.monthly_trend(
        marts(s, d).fct_orders, history_dim(s, d), W_ALL, versions="all"
    ),
    "cohort_retention_history": lambda s, d: cohort.cohort_retention(marts(s, d).fct_orders, history_dim(s, d), W),
    "rfm_aligned_end_date": _mart_query(
        lambda wh: segments.rfm_wide(wh.fct_orders, wh.dim_customers, W, missing="end_date")
    ),
    "cohort_drilldown_windowed": _mart_query(
        lambda wh: cohort.cohort_drilldown(
            wh.fct_orders, wh.dim_customers, DRILL_WINDOWED[0], DRILL_WINDOWED[1], W.cities, window=W
        )
    ),
    # sources, sinks and the scheduled build
    "registered_raw_views": _registered_raw,
    "calendar_csv": _calendar_csv,
    "exported_trend_csv": _exported_trend,
    "warehouse_build_report": _build_report,
    "retention_percent_labels": _mart_query(
        lambda wh: _cohort(wh).select("cohort", "month_index", percent_label("retention_rate").alias("label"))
    ),
    # SQL over the warehouse views (S2, S4): same results through spark.sql
    "sql_kpi": _sql(sql_views.sql_kpi),
    "sql_monthly_trend": _sql(sql_views.sql_monthly_trend),
    "sql_top_products": _sql(sql_views.sql_top_products),
    "cell_labels": _mart_query(
        lambda wh: _cohort(wh).select(
            "cohort", "month_index", cell_label("users", "retention_rate").alias("label")
        )
    ),
}
