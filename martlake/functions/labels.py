"""Display labels as column expressions.

Formatting happens on the executors, so a labelled result of any size can be
exported without passing through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlake.functions.columns import as_col

# Fixed values that must equal the reference's output format:
# thresholds 1e9 / 1e6 / 1e3 with suffixes B (2 decimals), M (1 decimal),
# K (0 decimals), otherwise a thousands-grouped 2-decimal amount; the currency
# sign is the euro sign and an unparsable value reads "€0".
EURO = "€"


def _fixed(value: Column, digits: int) -> Column:
    """Fixed-point text with ``digits`` decimals and no grouping.

    ``format_number`` rounds the exact binary value of the double half to
    even, the rule of Python's ``f`` format (``format_string`` rounds the
    shortest decimal form half up, which differs on ties such as 0.5 and
    near-ties such as 2.675); its grouping commas are dropped.
    """
    return F.translate(F.format_number(value, digits), ",", "")


def currency_label(value: Column | str) -> Column:
    """Compact euro label of an amount.

    Text that does not parse as a number becomes ``€0``; negative amounts take
    the grouped 2-decimal branch.
    """
    v = as_col(value).cast("string").try_cast("double")
    return (
        F.when(v.isNull(), F.lit(f"{EURO}0"))
        .when(F.isnan(v), F.lit(f"{EURO}nan"))
        .when(v == float("inf"), F.lit(f"{EURO}infB"))
        .when(v == float("-inf"), F.lit(f"{EURO}-inf"))
        .when(v >= 1e9, F.concat(F.lit(EURO), _fixed(v / 1e9, 2), F.lit("B")))
        .when(v >= 1e6, F.concat(F.lit(EURO), _fixed(v / 1e6, 1), F.lit("M")))
        .when(v >= 1e3, F.concat(F.lit(EURO), _fixed(v / 1e3, 0), F.lit("K")))
        .otherwise(F.concat(F.lit(EURO), F.format_number(v, 2)))
    )


def grouped_int_label(value: Column | str) -> Column:
    """Thousands-grouped integer, e.g. ``12,345`` (KPI counts)."""
    return F.format_number(as_col(value).cast("long"), 0)


def euro_2dp_label(value: Column | str) -> Column:
    """``€`` plus a plain 2-decimal amount (KPI average order value)."""
    return F.concat(F.lit(EURO), _fixed(as_col(value).cast("double"), 2))


def percent_label(share: Column | str) -> Column:
    """Share x 100 rounded to one decimal, as text, with a ``%`` suffix.

    The rounding is the table rounding of the original: scale by 10, round
    half to even (``rint``), scale back; the text is that one-decimal value.
    """
    rounded = F.rint(as_col(share).cast("double") * 100.0 * 10.0) / 10.0
    return F.concat(_fixed(rounded, 1), F.lit("%"))


def cell_label(users: Column | str, rate: Column | str) -> Column:
    """Heat-map cell text: user count, newline, rate x 100 with one decimal."""
    return F.concat(
        as_col(users).cast("long").cast("string"),
        F.lit(" users\n"),
        _fixed(as_col(rate).cast("double") * 100.0, 1),
        F.lit("%"),
    )
