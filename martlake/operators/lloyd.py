"""K-means from given start centres, in whole numbers (A4).

Coordinates are rounded to millionths, and equal points are one with a weight,
so that the sums of a cluster are sums of integers: exact, and the same whatever
the order in which tasks add. A round assigns each point by an expression and
adds up by cluster with partial aggregation; what reaches the driver is a row
for each cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = 1_000_000

Centre = tuple[float, ...]


def in_units(value: Column) -> Column:
    """A coordinate in millionths, as a whole number."""
    return F.round(value * F.lit(UNIT)).cast("long")


def nearest(coordinates: Sequence[str], centres: Sequence[Centre]) -> Column:
    """Number of the nearest centre; the smaller number of equally near ones."""

    def distance(centre: Centre) -> Column:
        total = None
        for name, at in zip(coordinates, centre, strict=True):
            off = F.col(name).cast("double") - F.lit(float(at))
            total = off * off if total is None else total + off * off
        return total

    return F.array_min(F.array(*[F.struct(distance(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))["i"]


def weighted(points: DataFrame, coordinates: Sequence[str]) -> DataFrame:
    """Distinct points with the number of their copies as ``weight``."""
    return points.groupBy(*coordinates).agg(F.count(F.lit(1)).alias("weight"))


def centres(points: DataFrame, coordinates: Sequence[str], start: Sequence[Centre], max_iter: int = 300) -> list[Centre]:
    """The centres where Lloyd's rounds come to rest.

    ``points`` has whole numbers in ``coordinates`` and a ``weight``; it is read once a
    round. A centre without points stays where it is. Rounds end when no centre
    moves; more than ``max_iter`` of them are an error.
    """
    now = [tuple(float(x) for x in c) for c in start]
    for _ in range(max_iter):
        own = points.withColumn("_centre", nearest(coordinates, now)).groupBy("_centre")
        sums = [F.sum(F.col(c) * F.col("weight")).alias(c) for c in coordinates]
        rows = own.agg(F.sum("weight").alias("weight"), *sums).collect()  # a row for each centre
        moved = list(now)
        for r in rows:
            moved[r["_centre"]] = tuple(r[c] / r["weight"] for c in coordinates)
        if moved == now:
            return now
        now = moved
    raise RuntimeError(f"k-means did not converge within {max_iter} rounds")
