from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martlake.operators import segments
from martlake.operators.filters import Window
from tests.conftest import make_dim, make_fct

# window 2023-01-01 .. 2023-12-31, split day 2023-07-02
W23 = Window.of("2023-01-01", "2023-12-31")


def _fixture(spark):
    fct = make_fct(
        spark,
        [
            ("a1", 1, "2023-02-01", 10),  # only in A
            ("b1", 2, "2023-09-01", 20),  # only in B
            ("c1", 3, "2023-03-01", 30),  # in both
            ("c2", 3, "2023-10-01", 40),
            ("s1", 4, "2023-07-02", 50),  # on the split day: counted in both
        ],
    )
    dim = make_dim(spark, [(i, "City A") for i in range(1, 5)])
    return fct, dim


def test_rfm_alignment_and_missing_rule(spark):
    fct, dim = _fixture(spark)
    wide = {r.customer_id: r for r in segments.rfm_wide(fct, dim, W23).collect()}
    assert sorted(wide) == [1, 2, 3, 4]
    end = dt.date(2023, 12, 31)
    # customer 1 absent from B: last order read as the epoch (parity)
    assert wide[1].frequency_b == 0 and wide[1].recency_b == (end - dt.date(1970, 1, 1)).days
    assert wide[1].recency_a == (end - dt.date(2023, 2, 1)).days
    assert wide[2].frequency_a == 0 and str(wide[2].monetary_a) == "0.00"
    assert wide[4].frequency_a == 1 and wide[4].frequency_b == 1
    intent = {r.customer_id: r for r in segments.rfm_wide(fct, dim, W23, missing="end_date").collect()}
    assert intent[1].recency_b == 0


def test_rfm_long_two_rows_per_customer(spark):
    fct, dim = _fixture(spark)
    long = segments.rfm_long(segments.rfm_wide(fct, dim, W23))
    assert long.count() == 8
    assert sorted(r.snapshot for r in long.where("customer_id = 3").collect()) == ["A", "B"]


def test_scaled_features_are_standardised(spark):
    fct, dim = _fixture(spark)
    scaled = segments.rfm_scaled(segments.rfm_wide(fct, dim, W23), digits=None)
    for c in segments.FEATURES:
        vals = [r[f"z_{c}_a"] for r in scaled.collect()] + [r[f"z_{c}_b"] for r in scaled.collect()]
        mean = sum(vals) / len(vals)
        var = sum((v - mean) ** 2 for v in vals) / len(vals)
        assert abs(mean) < 1e-9 and abs(var - 1.0) < 1e-9


def test_clusters_and_transition_invariants(spark):
    from martlake.plans.catalog import W, warehouse
    from tests.conftest import SF_SMALL

    wh = warehouse(spark, SF_SMALL)
    wide = segments.rfm_wide(wh.fct_orders, wh.dim_customers, W)
    clusters = segments.rfm_clusters(segments.rfm_scaled(wide, digits=None), k=4, seed=42)
    n = wide.count()
    assert clusters.count() == n
    counts = segments.transition_counts(clusters, 4)
    assert counts.columns == ["cluster_a", "b0", "b1", "b2", "b3"]
    total = counts.select(sum(F.col(f"b{j}") for j in range(4)).alias("t")).agg(F.sum("t")).first()[0]
    assert total == n
    shares = segments.transition_shares(clusters)
    sums = shares.groupBy("cluster_a").agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)
    # relabelled: cluster 0 has the highest mean monetary value
    joined = clusters.join(wide, "customer_id")
    means = {r.cluster_a: r.m for r in joined.groupBy("cluster_a").agg(F.avg("monetary_a").alias("m")).collect()}
    assert max(means, key=means.get) == 0
    # deterministic with the same seed
    again = segments.rfm_clusters(segments.rfm_scaled(wide, digits=None), k=4, seed=42)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, clusters.collect()))


def test_clusters_empty_when_a_period_has_no_customers(spark):
    # every order falls in period A of this window: the original shows no segmentation
    fct = make_fct(spark, [("a1", 1, "2023-02-01", 10), ("a2", 2, "2023-03-01", 20)])
    dim = make_dim(spark, [(1, "City A"), (2, "City A")])
    scaled = segments.rfm_scaled(segments.rfm_wide(fct, dim, W23), digits=None)
    clusters = segments.rfm_clusters(scaled, k=2)
    assert clusters.count() == 0
    assert clusters.columns == ["customer_id", "cluster_a", "cluster_b"]
    assert segments.transition_counts(clusters, 2).count() == 0


def _plain_lloyd(points, start):
    now = [list(c) for c in start]
    while True:
        own = [[] for _ in now]
        for p in points:
            off = [sum((x - y) ** 2 for x, y in zip(p, c, strict=True)) for c in now]
            own[off.index(min(off))].append(p)
        after = [[sum(x) / len(ps) for x in zip(*ps, strict=True)] if ps else c for ps, c in zip(own, now, strict=True)]
        if after == now:
            return now
        now = after


def test_lloyd_equals_plain_rounds(spark):
    from martlake.operators import lloyd

    rng = random.Random(5)
    points = [tuple(rng.choice([0, 40, 90]) + rng.randrange(20) for _ in range(2)) for _ in range(400)]
    start = [(0, 0), (50, 50), (100, 100), (10_000, 10_000)]  # the last one gets no points and stays
    frame = lloyd.weighted(spark.createDataFrame(points, "x long, y long"), ["x", "y"])
    assert frame.count() < 400 and frame.agg(F.sum("weight")).first()[0] == 400
    found = lloyd.centres(frame, ["x", "y"], start)
    assert found == [tuple(c) for c in _plain_lloyd(points, start)]
    with pytest.raises(RuntimeError, match="converge"):
        lloyd.centres(frame, ["x", "y"], start, max_iter=1)


def test_clusters_from_start_need_both_periods(spark):
    from martlake.operators import segments as seg

    names = [f"z_{c}_{p}" for p in "ab" for c in seg.FEATURES]
    schema = "customer_id long, frequency_a long, frequency_b long, " + ", ".join(f"{n} double" for n in names)
    start = [(0.0, 0.0, 0.0), (1.0, 1.0, 1.0)]
    one = spark.createDataFrame([(1, 1, 0, *[0.0] * 6)], schema)
    assert seg.rfm_clusters_from(one, start).collect() == []
    both = spark.createDataFrame([(1, 1, 1, 0.1, 0.1, 0.1, 0.9, 0.9, 0.9), (2, 1, 1, *[0.5] * 6)], schema)
    rows = {r.customer_id: (r.cluster_a, r.cluster_b) for r in seg.rfm_clusters_from(both, start).collect()}
    assert rows[1] == (1, 0)  # numbered by monetary descending
