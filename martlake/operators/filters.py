"""Filters and analysis-window parameters (F1-F8, J2 restriction, M12).

The analysis window **W** is ``(start_date, end_date, cities)``; dates are
inclusive and an empty city list means no city predicate.  Predicates are
plain column expressions, so Catalyst pushes the date bounds into the parquet
scan and the city ``IN`` list into the dimension scan.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.columns import as_col
from martlake.functions.dates import add_months, as_date


@dataclass(frozen=True)
class Window:
    """Analysis window: inclusive dates (None: no bound) and an optional city list."""

    start: dt.date | None
    end: dt.date | None
    cities: tuple[str, ...] = field(default_factory=tuple)

    @classmethod
    def of(cls, start, end, cities: Sequence[str] | None = None) -> "Window":
        return cls(start and as_date(start), end and as_date(end), tuple(cities or ()))


def date_window(col: Column | str, start, end) -> Column:
    """Inclusive date range (F1); a bound that is None is open."""
    bounds = [as_col(col) >= F.lit(as_date(start))] if start else []
    bounds += [as_col(col) <= F.lit(as_date(end))] if end else []
    return reduce(and_, bounds) if bounds else F.lit(True)


def city_filter(col: Column | str, cities: Sequence[str] | None) -> Column | None:
    """City membership (F2); ``None`` (no predicate) for an empty selection."""
    if not cities:
        return None
    return as_col(col).isin(list(cities))


def in_month(col: Column | str, month: dt.date) -> Column:
    """Month equality written as a half-open range so it pushes down."""
    first = as_date(month).replace(day=1)
    c = as_col(col)
    return (c >= F.lit(first)) & (c < add_months(F.lit(first), 1))


def current_dimension(dim: DataFrame, cities: Sequence[str] | None = None, versions: str = "current") -> DataFrame:
    """Customer rows a fact joins to (J2 with decision D3).

    ``versions="current"`` keeps open rows only, so each customer matches at
    most once; ``versions="all"`` keeps every version (the reference's join,
    which multiplies facts of customers with several versions).
    """
    if versions == "current":
        dim = dim.where(F.col("is_current"))
    elif versions != "all":
        raise ValueError(f"unknown versions {versions!r}")
    pred = city_filter("city", cities)
    return dim.where(pred) if pred is not None else dim


def facts_in_window(
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    versions: str = "current",
    date_col: str = "order_date",
) -> DataFrame:
    """Fact rows inside **W** whose customer is in the selected dimension rows.

    With current versions the dimension contributes no columns, so the inner
    join is written as a left-semi join on ``customer_id``: the build side is
    a key set, the planner broadcasts it only when its estimated size is under
    the broadcast threshold, AQE re-checks with the real size, and a skewed
    customer in a sort-merge plan is split by AQE's skew-join handling.  With
    all versions the join is an inner join and keeps the fan-out (parity).
    """
    facts = fct.where(date_window(date_col, window.start, window.end))
    keys = current_dimension(dim, window.cities, versions).select("customer_id")
    if versions == "current":
        return facts.join(keys, "customer_id", "left_semi")
    return facts.join(keys, "customer_id", "inner")


def first_cohorts(cohort: DataFrame, n: int = 6, label_col: str = "cohort") -> DataFrame:
    """Keep rows of the ``n`` oldest cohorts.

    The ``n`` labels are a bounded top-k (``orderBy + limit``) joined back
    with a left-semi join.
    """
    if n < 1:
        raise ValueError("n must be positive")
    labels = cohort.select(label_col).distinct().orderBy(label_col).limit(n)
    return cohort.join(labels, label_col, "left_semi")


def city_list(dim: DataFrame) -> DataFrame:
    """Distinct cities, sorted."""
    return dim.select("city").distinct().orderBy("city")


def default_cities(dim: DataFrame, requested: Sequence[str] | None = None, n: int = 5) -> DataFrame:
    """Requested cities that exist, else the first ``n`` by name."""
    cities = dim.select("city").where(F.col("city").isNotNull()).distinct()
    if requested:
        wanted = dim.sparkSession.createDataFrame([(c,) for c in requested], "city string")
        return wanted.join(cities, "city", "left_semi").distinct().orderBy("city")
    return cities.orderBy("city").limit(n)


def split_by_tag(df: DataFrame, tag: str, col: str = "type") -> DataFrame:
    """Rows of one series of a combined actual/forecast frame (F8)."""
    return df.where(F.col(col) == tag)
