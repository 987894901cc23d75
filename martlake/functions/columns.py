"""Small column utilities shared by all helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """``n / d`` as double; 0.0 when ``d == 0`` and null when ``d`` is null."""
    n, d = as_col(numerator), as_col(denominator)
    return F.when(d == 0, F.lit(0.0)).otherwise(n.cast("double") / d.cast("double"))


def zero_if_null(c: Column | str) -> Column:
    """Null defaulting (P6); the literal takes the column's numeric type."""
    return F.coalesce(as_col(c), F.lit(0))


def is_current(valid_to: Column | str = "valid_to") -> Column:
    """Current-row flag of a type-2 history."""
    return as_col(valid_to).isNull()
