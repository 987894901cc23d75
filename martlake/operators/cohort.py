"""Cohort retention, matrices, decay curves and drill-down.

Plan of ``cohort_retention`` (skew-safe by construction):

1. facts in the dates of **W** -> distinct (customer, activity month).  The
   distinct is a hash aggregate with map-side combine, so a customer holding a
   third of all orders arrives at the shuffle as at most one row per month and
   task.  Only then the customers of **W** are kept by a semi join, whose
   inputs hold at most one row per customer and month.
2. window ``min(activity_month)`` per customer gives the cohort month.  The
   window partition of a customer is bounded by the number of calendar
   months, never by order volume.
3. count rows per (cohort month, month index).  Rows are already distinct per
   (customer, month), so ``count`` equals the reference's
   ``COUNT(DISTINCT customer)`` without a second distinct aggregation.

The per-cohort size is a window sum over the (small) cell table, so no join
is needed for the retention rate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from martlake.functions.columns import safe_ratio
from martlake.functions.dates import as_date, month_distance, month_label, month_start
from martlake.operators.filters import Window, current_dimension, date_window, first_cohorts, in_month
from martlake.operators.ordering import sort_bounded

# Fixed value: month indexes counted as retained users (inclusive); larger
# indexes keep their cell with 0 users.
MAX_MONTH_INDEX = 60

COHORT_COLUMNS = ["cohort", "cohort_month", "month_index", "users", "cohort_size", "retention_rate"]


def customer_months(facts: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Distinct (customer, activity month) pairs with each customer's cohort month.

    ``customers`` restricts them to the ids in its ``customer_id``; several
    versions of a customer count once, as distinct customers are counted.
    """
    activity = facts.select("customer_id", month_start("order_date").alias("activity_month")).distinct()
    if customers is not None:
        activity = activity.join(customers.select("customer_id"), "customer_id", "left_semi")
    return activity.withColumn("cohort_month", F.min("activity_month").over(W.partitionBy("customer_id")))


def cohort_counts(
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    versions: str = "current",
    max_index: int = MAX_MONTH_INDEX,
) -> DataFrame:
    """Users per (cohort, month index) (G8); index > ``max_index`` keeps 0 users."""
    facts = fct.where(date_window("order_date", window.start, window.end))
    cm = customer_months(facts, current_dimension(dim, window.cities, versions))
    idx = month_distance("cohort_month", "activity_month")
    cells = cm.groupBy("cohort_month", idx.cast("long").alias("month_index")).agg(
        F.count(F.when(idx.between(0, max_index), F.lit(1))).alias("users")
    )
    return cells.select(
        month_label("cohort_month").alias("cohort"),
        "cohort_month",
        "month_index",
        F.col("users").cast("long").alias("users"),
    )


def cohort_retention(
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    versions: str = "current",
    max_index: int = MAX_MONTH_INDEX,
) -> DataFrame:
    """Cohort table with size and retention rate, newest cohort first.

    An empty selection gives an empty frame with the six columns.
    """
    cells = cohort_counts(fct, dim, window, versions, max_index)
    size = F.sum(F.when(F.col("month_index") == 0, F.col("users"))).over(W.partitionBy("cohort", "cohort_month"))
    table = (
        cells.withColumn("cohort_size", size.cast("long"))
        .withColumn("retention_rate", safe_ratio("users", "cohort_size"))
        .select(*COHORT_COLUMNS)
    )
    return sort_bounded(table, F.desc("cohort_month"), F.asc("month_index"))


def cohort_size(cohort: DataFrame) -> DataFrame:
    """One row per cohort with its size."""
    return cohort.groupBy("cohort", "cohort_month").agg(
        F.sum(F.when(F.col("month_index") == 0, F.col("users"))).cast("long").alias("cohort_size")
    )


def month_indexes(window: Window) -> range:
    """The month indexes that a window can hold: 0 up to its length in months."""
    return range((window.end.year - window.start.year) * 12 + window.end.month - window.start.month + 1)


def _wide(cohort: DataFrame, window: Window, value_col: str, fill, cast: str) -> DataFrame:
    # a cohort has one row per month index, so each column is the value of that row
    value = F.col(value_col).cast(cast)
    columns = [F.coalesce(F.max(F.when(F.col("month_index") == i, value)), F.lit(fill).cast(cast)).alias(f"m{i}") for i in month_indexes(window)]
    return cohort.groupBy("cohort").agg(*columns)


def cohort_matrix(cohort: DataFrame, window: Window) -> DataFrame:
    """Retention rate as cohort x month index, gaps 0 (G13); columns ``m<i>`` for all months of the window."""
    return _wide(cohort, window, "retention_rate", 0.0, "double")


def cohort_users_matrix(cohort: DataFrame, window: Window) -> DataFrame:
    """User counts as cohort x month index, gaps 0."""
    return _wide(cohort, window, "users", 0, "long")


def decay_curves(cohort: DataFrame, n: int = 6) -> DataFrame:
    """Retention by month index for the ``n`` oldest cohorts."""
    return first_cohorts(cohort, n).select("cohort", "month_index", "retention_rate")


def cohort_drilldown(
    fct: DataFrame,
    dim: DataFrame,
    cohort_label: str,
    month_index: int,
    cities=None,
    window: Window | None = None,
    versions: str = "current",
    limit: int = 1000,
) -> DataFrame:
    """Orders of one cohort in one month.

    The cohort is computed over the customer's whole history unless a
    ``window`` is given (defect D5 kept as the default).  The limit is the
    feature of the drill-down; rows are ordered by (customer, order) so it is
    deterministic.

    A customer's first order falls in month M exactly when the customer has
    an order in M and none before M.  So instead of aggregating every
    customer's whole history, the plan reads three date-pruned slices of the
    fact: the customers active in M, those of them with an earlier order (a
    semi join against the candidates), and the orders of the target month.
    """
    cohort_date = as_date(f"{cohort_label}-01")
    target = _add_months_py(cohort_date, month_index)
    keys = current_dimension(dim, cities if window is None else (cities or window.cities), versions)
    facts = fct if window is None else fct.where(date_window("order_date", window.start, window.end))
    # customers are made distinct before they are joined, so no join input holds a hot customer
    candidates = facts.where(in_month("order_date", cohort_date)).select("customer_id").distinct()
    candidates = candidates.join(keys.select("customer_id"), "customer_id", "left_semi")
    earlier = facts.where(F.col("order_date") < F.lit(cohort_date)).select("customer_id").distinct()
    members = candidates.join(earlier, "customer_id", "left_anti")
    return (
        fct.where(in_month("order_date", target))
        .join(members, "customer_id", "left_semi")
        .select("customer_id", "order_id", "revenue_euro", "order_date")
        .orderBy("customer_id", "order_id")
        .limit(limit)
    )


def _add_months_py(d: dt.date, months: int) -> dt.date:
    y, m = divmod(d.month - 1 + months, 12)
    return dt.date(d.year + y, m + 1, 1)

