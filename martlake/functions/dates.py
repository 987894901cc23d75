"""Date helpers.

All of them are built-in column expressions, so they stay inside whole-stage
code generation and never leave the JVM.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlake.functions.columns import as_col


def to_date_ntz(ts: Column | str) -> Column:
    """Timestamp without zone to date (P3): no session time-zone shift."""
    return as_col(ts).cast("date")


def month_start(d: Column | str) -> Column:
    """First day of the month as a DATE."""
    return F.trunc(as_col(d), "month")


def week_start(d: Column | str) -> Column:
    """Monday of the ISO week as a DATE."""
    return F.trunc(as_col(d), "week")


def month_label(d: Column | str) -> Column:
    """``YYYY-MM`` label of a date (P10)."""
    return F.date_format(as_col(d), "yyyy-MM")


def label_to_month(label: Column | str) -> Column:
    """Back from a ``YYYY-MM`` label to the month's first day (P10)."""
    return F.to_date(F.concat(as_col(label), F.lit("-01")), "yyyy-MM-dd")


def month_distance(start: Column | str, end: Column | str) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    Jan 31 -> Feb 1 is 1, unlike ``months_between``-based differences.
    """
    s, e = as_col(start), as_col(end)
    return (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))


def add_months(d: Column | str, months: Column | int) -> Column:
    """Calendar month arithmetic with end-of-month clamping."""
    n = F.lit(months) if isinstance(months, int) else months
    return F.add_months(as_col(d), n)


def day_ordinal(d: Column | str) -> Column:
    """Days since 1970-01-01 (P14); an offset of the proleptic ordinal."""
    return F.unix_date(as_col(d))


def days_between(later: Column | str, earlier: Column | str) -> Column:
    """``later - earlier`` in days."""
    return F.datediff(as_col(later), as_col(earlier))


def window_split_day(start: dt.date, end: dt.date) -> dt.date:
    """Split day of an analysis window: ``start + max(1, days // 2)``.

    Computed on the driver from two parameters, never from data.
    """
    days = (end - start).days
    return start + dt.timedelta(days=max(1, days // 2))


def as_date(value: dt.date | str) -> dt.date:
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value)[:10])


def date_dimension(bounds: DataFrame, start_col: str = "start_date", end_col: str = "end_date") -> DataFrame:
    """Calendar rows with the seed's eight columns for every range in ``bounds``.

    ``bounds`` holds one row per range (e.g. the min/max order date of a fact
    table); each range is exploded on the executors, so the calendar is never
    assembled on the driver.
    """
    days = bounds.select(
        F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"))).alias("date_day")
    ).distinct()
    d = F.col("date_day")
    return days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.date_format(d, "EEEE").alias("day_of_week"),
    )
