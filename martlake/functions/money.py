"""Money helpers.

Amounts are stored as integer cents and turned into decimals as late as
possible.  The conversion goes through a double division followed by a
decimal cast, which is exact for cent amounts up to 2**53 and rounds to the
nearest cent for any other precision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake.functions.columns import as_col


def cents_to_euros(cents: Column | str, precision: int = 2) -> Column:
    """``cents / 100`` as ``decimal(18, precision)``."""
    return (as_col(cents).cast("double") / F.lit(100.0)).cast(f"decimal(18,{precision})")


def margin_euros(
    price_cents: Column | str,
    cost_cents: Column | str,
    precision: int = 2,
    mode: str = "correct",
) -> Column:
    """Price minus cost in euros (P5).

    ``mode="correct"`` converts the difference.  ``mode="reference"``
    reproduces the unparenthesised text macro, which evaluates
    ``price_cents - cost_cents / 100.0`` (defect D1), for parity runs.
    """
    price, cost = as_col(price_cents), as_col(cost_cents)
    if mode == "correct":
        return cents_to_euros(price - cost, precision)
    if mode == "reference":
        return (price.cast("double") - cost.cast("double") / F.lit(100.0)).cast(
            f"decimal(18,{precision})"
        )
    raise ValueError(f"unknown margin mode {mode!r}")


def cents_sum_to_double(cents: Column | str) -> Column:
    """Aggregate: total cents as a double euro amount (P20)."""
    return F.sum(as_col(cents)).cast("double") / F.lit(100.0)
