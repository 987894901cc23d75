"""Ordering of small final results (O2, O3).

Results such as a monthly trend, a weekly series or a cohort table have one
row per calendar month, week or cohort cell: their size is bounded by the
calendar, not by the data volume.  For those, a global ``orderBy`` would add a
range-partitioning exchange plus a sampling job; an exchange of the few
aggregated rows to one partition and a sort there give the same total order.
The exchange keeps the aggregation before it parallel.  Never use this for
results that grow with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def sort_bounded(df: DataFrame, *cols: Column | str) -> DataFrame:
    """Total order of a calendar-bounded result inside one partition."""
    return df.repartition(1).sortWithinPartitions(*cols)
