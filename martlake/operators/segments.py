"""Recency / frequency / monetary segmentation and transitions.

Plan: both period snapshots come out of **one** aggregation keyed by customer
(conditional aggregates for period A and period B), so the two snapshots are
aligned by construction (J7) without a second aggregation or an outer join.
The wide row per customer carries both feature sets; k-means is trained on
the two periods stacked (``explode``, no shuffle) and predicts both periods in
place, so the A-to-B pairing (J11) needs no join either.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlake.functions.dates import days_between, window_split_day
from martlake.functions.labels import percent_label
from martlake.operators import lloyd
from martlake.operators.filters import Window, current_dimension, date_window
from martlake.session import cut_lineage

PERIODS = ("a", "b")
FEATURES = ("recency", "frequency", "monetary")
# Fixed value: a customer absent from a period has its last order read as
# day 0 of the epoch (defect D6 kept as the default).
MISSING_LAST_ORDER = dt.date(1970, 1, 1)
CLUSTERS = "customer_id long, cluster_a int, cluster_b int"


def rfm_wide(
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    versions: str = "current",
    missing: str = "epoch",
) -> DataFrame:
    """One row per customer active in **W** with both period snapshots.

    Period A is ``[start, split]`` and period B ``[split, end]`` with
    ``split = start + max(1, days // 2)``; both ends are inclusive, so orders
    on the split day count in both.  Recency of both periods is measured to
    the end of the whole window (D8).  ``missing="epoch"`` gives an absent
    customer the epoch as last order (D6); ``missing="end_date"`` gives 0 days.
    """
    split = window_split_day(window.start, window.end)
    f = fct.where(date_window("order_date", window.start, window.end))
    d = F.col("order_date")
    in_period = {"a": d <= F.lit(split), "b": d >= F.lit(split)}
    aggs = []
    for p, cond in in_period.items():
        aggs += [
            F.max(F.when(cond, d)).alias(f"last_order_{p}"),
            F.count(F.when(cond, F.col("order_id"))).alias(f"frequency_{p}"),
            F.sum(F.when(cond, F.col("revenue_euro"))).alias(f"_monetary_{p}"),
        ]
    # aggregated before the customers are joined: no input of the join holds a hot customer
    agg = f.groupBy("customer_id").agg(*aggs)
    chosen = current_dimension(dim, window.cities, versions).select("customer_id")
    if versions == "current":
        agg = agg.join(chosen, "customer_id", "left_semi")
    else:  # each version of a customer repeats the orders
        times = chosen.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_times"))
        agg = agg.join(times, "customer_id")
        for p in PERIODS:
            agg = agg.withColumn(f"frequency_{p}", F.col(f"frequency_{p}") * F.col("_times"))
            agg = agg.withColumn(f"_monetary_{p}", F.col(f"_monetary_{p}") * F.col("_times").cast("decimal(10,0)"))
    end = F.lit(window.end)
    cols = [F.col("customer_id")]
    for p in PERIODS:
        last = F.col(f"last_order_{p}")
        if missing == "epoch":
            recency = days_between(end, F.coalesce(last, F.lit(MISSING_LAST_ORDER)))
        elif missing == "end_date":
            recency = F.coalesce(days_between(end, last), F.lit(0))
        else:
            raise ValueError(f"unknown missing rule {missing!r}")
        cols += [
            last,
            recency.cast("long").alias(f"recency_{p}"),
            F.col(f"frequency_{p}").cast("long").alias(f"frequency_{p}"),
            F.coalesce(F.col(f"_monetary_{p}").cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)")).alias(
                f"monetary_{p}"
            ),
        ]
    return agg.select(*cols)


def rfm_long(wide: DataFrame) -> DataFrame:
    """Both snapshots stacked with a ``snapshot`` tag (U3); row-wise, no shuffle."""
    rows = F.array(
        *[
            F.struct(
                F.lit(p.upper()).alias("snapshot"),
                F.col(f"last_order_{p}").alias("last_order"),
                *[F.col(f"{c}_{p}").alias(c) for c in FEATURES],
            )
            for p in PERIODS
        ]
    )
    return wide.select("customer_id", F.explode(rows).alias("r")).select("customer_id", "r.*")


def scaler_stats(wide: DataFrame) -> dict[str, tuple[float, float]]:
    """Mean and population std of each feature over both periods pooled (A3).

    One global aggregate; the single result row is the only thing collected.
    A zero std is replaced by 1 so the feature stays centred.
    """
    pooled = rfm_long(wide)
    exprs = []
    for c in FEATURES:
        x = F.col(c).cast("double")
        exprs += [F.avg(x).alias(f"{c}_mean"), F.stddev_pop(x).alias(f"{c}_std")]
    row = pooled.agg(*exprs).first()
    stats = {}
    for c in FEATURES:
        mean = row[f"{c}_mean"]
        std = row[f"{c}_std"]
        stats[c] = (mean if mean is not None else 0.0, std if std else 1.0)
    return stats


def rfm_scaled(wide: DataFrame, digits: int | None = None) -> DataFrame:
    """Standardised features ``z_<feature>_<period>`` added to the wide frame (A3)."""
    stats = scaler_stats(wide)
    out = wide
    for p in PERIODS:
        for c in FEATURES:
            mean, std = stats[c]
            z = (F.col(f"{c}_{p}").cast("double") - F.lit(mean)) / F.lit(std)
            out = out.withColumn(f"z_{c}_{p}", F.round(z, digits) if digits is not None else z)
    return out


def rfm_clusters(scaled: DataFrame, k: int = 4, seed: int = 42, max_iter: int = 300) -> DataFrame:
    """K-means on both periods pooled, predicted per period.

    Output: ``customer_id, cluster_a, cluster_b``.  Cluster numbers are made
    stable by relabelling centroids by monetary descending, then recency
    ascending.  The training rows are hash-partitioned by customer and sorted
    so k-means|| sees the same partitions on every run, and they are
    checkpointed to the shared checkpoint folder before the iterations start.
    A fit that ``max_iter`` rounds do not bring to rest is an error.
    """
    if not 2 <= k <= 8:
        raise ValueError("k must be in 2..8")
    spark = scaled.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    z_cols = [f"z_{c}_{p}" for p in PERIODS for c in FEATURES]
    base = cut_lineage(
        scaled.select("customer_id", "frequency_a", "frequency_b", *z_cols)
        .repartition(parts, "customer_id")
        .sortWithinPartitions("customer_id")
    )
    if not _both_active(base):
        return spark.createDataFrame([], CLUSTERS)
    feats = base
    for p in PERIODS:
        feats = VectorAssembler(inputCols=[f"z_{c}_{p}" for c in FEATURES], outputCol=f"features_{p}").transform(feats)
    feats = feats.select("customer_id", "features_a", "features_b")
    train = feats.select(F.explode(F.array("features_a", "features_b")).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(train)
    if model.summary.numIter >= max_iter:
        raise RuntimeError(f"k-means did not converge within {max_iter} rounds")

    relabel = _stable_numbers(model.clusterCenters())  # k x 3, bounded
    out = feats
    for p in PERIODS:
        out = model.setFeaturesCol(f"features_{p}").setPredictionCol(f"_pred_{p}").transform(out)
    return out.select(
        "customer_id",
        *[relabel[F.col(f"_pred_{p}")].cast("int").alias(f"cluster_{p}") for p in PERIODS],
    )


def _both_active(base: DataFrame) -> bool:
    """Like the original, no segmentation when either period has no customers (one aggregate row decides)."""
    active = base.agg(*[F.count(F.when(F.col(f"frequency_{p}") > 0, F.lit(1))).alias(p) for p in PERIODS]).first()
    return all(active[p] > 0 for p in PERIODS)


def _stable_numbers(centers: Sequence[Sequence[float]]) -> Column:
    """Cluster numbers by monetary descending, then recency ascending, as a map from those of the fit."""
    order = sorted(range(len(centers)), key=lambda i: (-centers[i][2], centers[i][0], i))
    return F.create_map(*[x for new, old in enumerate(order) for x in (F.lit(old), F.lit(new))])


def rfm_clusters_from(scaled: DataFrame, start: Sequence[Sequence[float]], max_iter: int = 300) -> DataFrame:
    """K-means from given start centres on both periods pooled, assigned per period.

    ``start`` holds (recency, frequency, monetary) in standardised units.  The
    rounds run over distinct points with weights in whole millionths
    (``lloyd``), so that the result doesn't depend on the order in which tasks
    add.  Output, cluster numbers and errors are those of ``rfm_clusters``.
    """
    base = scaled.select(
        "customer_id",
        *[f"frequency_{p}" for p in PERIODS],
        *[lloyd.in_units(F.col(f"z_{c}_{p}")).alias(f"u_{c}_{p}") for p in PERIODS for c in FEATURES],
    )
    base = cut_lineage(base)
    if not _both_active(base):
        return base.sparkSession.createDataFrame([], CLUSTERS)
    rows = F.array(*[F.struct(*[F.col(f"u_{c}_{p}").alias(c) for c in FEATURES]) for p in PERIODS])
    points = cut_lineage(lloyd.weighted(base.select(F.explode(rows).alias("r")).select("r.*"), FEATURES))
    found = lloyd.centres(points, FEATURES, [[x * lloyd.UNIT for x in c] for c in start], max_iter)
    number = _stable_numbers(found)
    return base.select(
        "customer_id",
        *[number[lloyd.nearest([f"u_{c}_{p}" for c in FEATURES], found)].cast("int").alias(f"cluster_{p}") for p in PERIODS],
    )


def transition_counts(clusters: DataFrame, k: int) -> DataFrame:
    """Customers moving from cluster A (rows) to cluster B (columns ``b<j>``).

    Explicit pivot values ``0..k-1`` keep the schema fixed even when fewer
    clusters come back.
    """
    wide = clusters.groupBy("cluster_a").pivot("cluster_b", list(range(k))).count()
    return wide.select(
        "cluster_a", *[F.coalesce(F.col(str(j)), F.lit(0)).cast("long").alias(f"b{j}") for j in range(k)]
    )


def transition_shares(clusters: DataFrame) -> DataFrame:
    """Share of each A cluster moving to each B cluster; rows sum to 1."""
    counts = clusters.groupBy("cluster_a", "cluster_b").agg(F.count(F.lit(1)).alias("customers"))
    # The window runs over the k x k count table, never over customers.
    total = F.sum("customers").over(W.partitionBy("cluster_a"))
    return counts.select("cluster_a", "cluster_b", "customers", (F.col("customers") / total).alias("share"))


def transition_labels(shares: DataFrame) -> DataFrame:
    """Percent labels of the share matrix."""
    return shares.select("cluster_a", "cluster_b", percent_label("share").alias("share_label"))


def rfm_transition(
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    k: int = 4,
    seed: int = 42,
    versions: str = "current",
    missing: str = "epoch",
) -> dict[str, DataFrame]:
    """End-to-end segmentation of M10: snapshots, scaling, clusters, transitions."""
    # one pass over the fact window: the per-customer table is checkpointed and
    # both the scaler statistics and the clustering read the checkpoint
    wide = cut_lineage(rfm_wide(fct, dim, window, versions, missing))
    scaled = rfm_scaled(wide, digits=None)
    clusters = rfm_clusters(scaled, k, seed)
    return {
        "snapshots": rfm_long(wide),
        "clusters": clusters,
        "counts": transition_counts(clusters, k),
        "shares": transition_shares(clusters),
    }
