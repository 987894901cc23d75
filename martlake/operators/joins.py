"""Fact-to-lookup join that splits hot keys (used by J8).

Adaptive execution splits a skewed sort-merge join only inside a shuffle map
stage; a join whose output is the final result (a row-level lookup written
as is) keeps a hot key in one task.  ``salted_lookup_join`` splits such keys
explicitly:

1. tasks sketch the frequent keys of the fact (``approx_top_k``: a fixed number of
   counters a task, merged by Spark), and the candidates are counted exactly;
2. a key is hot when it holds more than one partition's share of the rows,
   so there are at most ``partitions`` hot keys: that list has a proven size
   bound, is read by the driver and broadcast;
3. each fact row of a hot key gets one of ``ceil(count / share)`` salt
   values from a hash of the row (rows without a key get one too), the lookup rows of hot keys are copied once per salt value, and
   the join runs on (key, salt).  Cold keys keep salt 0.

Without hot keys the plain join is returned.  Whether the lookup is broadcast is
left to Spark's planner and to adaptive execution in both cases.

Every row is kept and the result equals the plain join.  Rows that are equal in
every column share a salt value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SALT = "_salt"
BUCKETS = "_buckets"
# The sketch misses no key that holds more than 2 * 3.5 / COUNTERS of the rows
# (twice its error bound), which is less than a partition's share.
COUNTERS_PER_PARTITION = 8
MOST_COUNTERS = 1_000_000


def hot_keys(facts: DataFrame, key: str, partitions: int) -> tuple[list, bool]:
    """Keys with more than one of ``partitions`` shares of the rows, as (key, number of shares); and whether keys are missing.

    The sketch holds hashes of keys, so that its size is bounded whatever the
    keys are.  Two passes over the key column at most, one where nothing is frequent.
    """
    if partitions * COUNTERS_PER_PARTITION > MOST_COUNTERS:
        partitions = MOST_COUNTERS // COUNTERS_PER_PARTITION
    counters = max(64, partitions * COUNTERS_PER_PARTITION)
    hashed = facts.select(F.when(F.col(key).isNotNull(), F.xxhash64(key)).alias("h"))
    top = F.expr(f"transform(approx_top_k(h, {min(counters, 2 * partitions)}, {counters}), t -> t.item)")
    row = hashed.agg(F.count(F.lit(1)).alias("n"), F.count("h").alias("with_key"), top.alias("top")).first()
    share = max(1, -(-row["n"] // partitions))
    missing = row["with_key"] < row["n"]
    top = [h for h in row["top"] or () if h is not None]  # the sketch counts missing keys as one
    if not top:
        return [], missing
    candidates = facts.select(key).where(F.xxhash64(key).isin(top))
    counts = candidates.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share)
    rows = counts.collect()  # at most as many as partitions
    return [(bytes(r[key]) if isinstance(r[key], bytearray) else r[key], -(-r["n"] // share)) for r in rows], missing


def salted_lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    partitions: int | None = None,
) -> DataFrame:
    """``facts.join(lookup, key, how)`` with hot keys spread over several tasks.

    ``lookup`` must be unique per ``key`` (a dimension); ``how`` is ``inner``
    or ``left``.  ``partitions`` defaults to ``spark.sql.shuffle.partitions``.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    if isinstance(facts.schema[key].dataType, (T.ArrayType, T.MapType, T.StructType)):
        raise ValueError(f"{key}: hot keys become literals, so the key must be a single value")
    spark = facts.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys, missing = hot_keys(facts, key, parts)
    if not keys and not missing:
        return facts.join(lookup, key, how)
    schema = T.StructType([facts.schema[key], T.StructField(BUCKETS, T.LongType())])
    hot = F.broadcast(spark.createDataFrame(keys, schema))
    # salted by the row itself, so that a task that runs again deals its rows alike
    row = F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns])
    salted_facts = facts.join(hot, key, "left").withColumn(
        SALT,
        F.when(F.col(key).isNull(), F.pmod(row, F.lit(parts)))  # matches nothing, but must not gather in one task
        .when(F.col(BUCKETS).isNull(), F.lit(0))
        .otherwise(F.pmod(row, F.col(BUCKETS)))
        .cast("int"),
    )
    # 0, but not as a literal: the optimiser would take the salt out of the join, and rows without a key gather again
    salted_lookup = lookup.withColumn(SALT, F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    if keys:
        # by literals, not by a join, whose estimated size would keep the planner from broadcasting a small lookup
        values, shares = [F.array(*map(F.lit, x)) for x in zip(*keys, strict=True)]
        copies = F.sequence(F.lit(1), F.get(shares, F.array_position(values, F.col(key)) - 1).cast("int") - 1)
        hot_rows = lookup.where(F.col(key).isin([k for k, _ in keys]))  # at most a row for each hot key
        salted_lookup = salted_lookup.unionByName(hot_rows.withColumn(SALT, F.explode(copies)))
    return salted_facts.drop(BUCKETS).join(salted_lookup, [key, SALT], how).drop(SALT)
