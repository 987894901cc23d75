"""Salted lookup join: equal to the plain join, hot keys spread over tasks."""

from __future__ import annotations

import contextlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martlake.operators.joins import hot_keys, salted_lookup_join
from tests.conftest import SF_SMALL


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@contextlib.contextmanager
def _conf(spark, conf):
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_salted_join_equals_plain_join_with_hot_key(spark):
    items = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    hot = items.agg(F.min("l_partkey")).first()[0]
    # a third of the items move to one product, some point to no product
    facts = items.select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") % 3 == 0, F.lit(hot))
        .when(F.col("l_linenumber") == 7, F.lit(-1))
        .otherwise(F.col("l_partkey"))
        .alias("k"),
    )
    lookup = spark.read.parquet(f"{SF_SMALL}/part.parquet").select(F.col("p_partkey").alias("k"), "p_retailprice")
    expected = {how: _rows(facts.join(lookup, "k", how).select("k", "l_linenumber", "l_orderkey", "p_retailprice"))
                for how in ("left", "inner")}
    # default thresholds: the planner broadcasts the small lookup, salted or not;
    # broadcasts off: the salted sort-merge join runs
    for conf in ({}, NO_BROADCAST):
        with _conf(spark, conf):
            for how in ("left", "inner"):
                got = salted_lookup_join(facts, lookup, "k", how, partitions=8)
                plan = got._jdf.queryExecution().executedPlan().toString()
                assert "_salt" in plan and ("SortMergeJoin" in plan) == bool(conf)
                assert _rows(got.select("k", "l_linenumber", "l_orderkey", "p_retailprice")) == expected[how]


def test_hot_key_lands_in_several_join_tasks(spark):
    # no broadcast of the lookup and no coalescing: the (key, salt) sort-merge
    # join alone decides where the hot key's rows go
    with _conf(spark, NO_BROADCAST):
        _check_spread(spark)


def _check_spread(spark):
    facts = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id")).alias("k"), F.col("id").alias("row"))
    lookup = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = salted_lookup_join(facts, lookup, "k", "inner", partitions=32)
    spread = (
        joined.where(F.col("k") == 1)
        .select(F.spark_partition_id().alias("p"))
        .distinct()
        .count()
    )
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 4000
    assert spread > 1


def test_rows_keep_their_salt_and_null_keys_spread(spark):
    facts = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"), F.col("id").alias("row"))
    lookup = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    with _conf(spark, NO_BROADCAST):
        placed = []
        for order in ("row", F.desc("row")):  # the same rows in another order
            joined = salted_lookup_join(facts.orderBy(order), lookup, "k", "left", partitions=32)
            placed.append({r.row: (r.p, r.v) for r in joined.select("row", "v", F.spark_partition_id().alias("p")).collect()})
    assert placed[0] == placed[1] and len(placed[0]) == 4000
    assert len({p for row, (p, _) in placed[0].items() if row % 2 == 0}) > 1
    assert all(v is None if row % 2 == 0 else v == row * 10 for row, (_, v) in placed[0].items())


def test_hot_binary_keys(spark):
    facts = spark.range(3000).select(F.unhex(F.sha2(F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")), 256)).alias("k"), "id")
    lookup = facts.groupBy("k").agg(F.count("id").alias("n"))
    with _conf(spark, NO_BROADCAST):
        joined = salted_lookup_join(facts, lookup, "k", "left", partitions=8)
        assert "_salt" in joined._jdf.queryExecution().executedPlan().toString()
        assert {(r.id, r.n) for r in joined.collect()} == {(i, 1500 if i % 2 == 0 else 1) for i in range(3000)}


def test_plain_join_without_hot_keys(spark):
    facts = spark.range(4000).select((F.col("id") % 1000).alias("k"), "id")
    lookup = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    joined = salted_lookup_join(facts, lookup, "k", "inner", partitions=8)
    assert "_salt" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 4000


@pytest.mark.parametrize("kind", ["long", "string", "binary"])
def test_hot_keys_are_exact(spark, kind):
    # key j below 12 holds 1 row in 2 ** (j + 1); everything else is a key of its own
    n, parts = 40_000, 16
    low = F.expr("CAST(log2(CAST(id & -id AS DOUBLE)) AS INT)")
    rows = spark.range(1, n + 1).select(F.when(low < 12, low).otherwise(F.col("id") + 100).cast("string").cast(kind if kind != "long" else "long").alias("k"))
    found, missing = hot_keys(rows, "k", parts)
    counts = Counter(r.k if not isinstance(r.k, bytearray) else bytes(r.k) for r in rows.collect())
    share = -(-n // parts)
    want = {k: -(-c // share) for k, c in counts.items() if c > share}
    assert dict(found) == want and len(want) == 3
    assert not missing
    assert hot_keys(rows.limit(0), "k", parts) == ([], False)
    assert hot_keys(spark.range(5).select(F.lit(None).cast(kind).alias("k")), "k", parts) == ([], True)


def test_sketch_finds_every_hot_key_among_many_cold_ones(spark):
    # 30 keys just above a share, dealt evenly among half a million others
    parts = 64
    n = 600_000
    hot = F.when(F.col("id") % 32 < 16, F.floor(F.col("id") / 32) % 30)
    rows = spark.range(n).select(F.coalesce(hot, F.col("id") + 1000).alias("k"))
    found, _ = hot_keys(rows, "k", parts)
    assert sorted(k for k, _ in found) == list(range(30))


def test_nested_keys_are_refused(spark):
    facts = spark.createDataFrame([([1.0],)], "k array<double>")
    with pytest.raises(ValueError, match="single value"):
        salted_lookup_join(facts, facts, "k", "inner")
