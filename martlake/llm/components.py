"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.llm.common import stored


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node and component (its smallest node) of all nodes of ``links`` (a long, b long).

    Each round hangs every node's larger neighbours on its smallest neighbour,
    then the smaller ones. The number of links never grows, and a node's
    neighbours are only ever aggregated or joined, never held together. Rounds
    end when the links form stars.
    """
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), name)
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).filter("hi <> lo").distinct()
        # small star: a node's smaller neighbours, and the node itself, hang on the smallest of them
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(low, "hi")
        small = joined.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(joined.select("hi", F.col("m").alias("lo")))
        new = stored(small.filter("hi <> lo").distinct(), name)
        # stars: every upper node has one lower node, and no lower node is an upper one
        lows = new.select("lo").distinct()
        deep = new.join(lows.withColumnRenamed("lo", "hi"), "hi", "left_semi").limit(1).count()
        several = 0 if deep else new.groupBy("hi").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
        edges = new
        if not deep and not several:
            break
    roots = edges.select(F.col("lo").alias("node")).distinct()
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
