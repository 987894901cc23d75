"""Headline metrics over an analysis window.

Every function takes the fact and dimension DataFrames plus a ``Window`` and
returns a lazy DataFrame.  Aggregations group on low-cardinality keys (month,
week, product) so partial aggregation collapses each map task to a handful of
rows before the shuffle, whatever the skew of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.columns import zero_if_null
from martlake.functions.dates import month_start, week_start
from martlake.functions.money import cents_sum_to_double
from martlake.operators.filters import Window, current_dimension, date_window, facts_in_window
from martlake.operators.joins import salted_lookup_join
from martlake.operators.ordering import sort_bounded

SUM_EURO = "decimal(38,2)"


def euro_sum(col: str) -> "F.Column":
    """Sum of a ``decimal(18,2)`` euro column as ``decimal(38,2)``."""
    return F.sum(col).cast(SUM_EURO)


def kpi(fct: DataFrame, dim: DataFrame, window: Window, versions: str = "current", unique_orders: bool = True) -> DataFrame:
    """One-row headline figures over **W**.

    Distinct orders, revenue, average order value (``sum / count`` as double,
    6 decimals) and distinct customers; an empty window gives zeros.

    ``order_id`` is unique in the fact (check Q1), and an order has one customer:
    orders are counted per customer, and customers are the rows of that.  So
    both distinct counts need one aggregation by customer, made before the
    customers are joined, instead of a row for each distinct count.
    ``versions="all"`` repeats revenue, not orders, for each version of a
    customer.  For a fact whose order ids repeat, ``unique_orders=False`` counts
    them exactly, by expanding the joined rows.
    """
    if not unique_orders:
        f = facts_in_window(fct, dim, window, versions)
        sums = f.agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("revenue_euro").alias("_revenue"),
            F.count("revenue_euro").alias("_n"),
            F.count_distinct("customer_id").alias("active_customers"),
        )
    else:
        f = fct.where(date_window("order_date", window.start, window.end))
        own = f.groupBy("customer_id").agg(
            F.count("order_id").alias("_orders"), F.sum("revenue_euro").alias("_revenue"), F.count("revenue_euro").alias("_n")
        )
        chosen = current_dimension(dim, window.cities, versions).select("customer_id")
        if versions == "current":
            own = own.join(chosen, "customer_id", "left_semi")
        else:
            times = chosen.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_times"))
            own = own.join(times, "customer_id").withColumns(
                {"_revenue": F.col("_revenue") * F.col("_times").cast("decimal(10,0)"), "_n": F.col("_n") * F.col("_times")}
            )
        sums = own.agg(
            F.sum("_orders").alias("orders"),
            F.sum("_revenue").alias("_revenue"),
            F.sum("_n").alias("_n"),
            F.count("customer_id").alias("active_customers"),
        )
    return sums.select(
        zero_if_null("orders").cast("long").alias("orders"),
        F.coalesce(F.col("_revenue").cast(SUM_EURO), F.lit(0).cast(SUM_EURO)).alias("revenue"),
        F.coalesce(F.round(F.col("_revenue").cast("double") / F.nullif("_n", F.lit(0)), 6), F.lit(0.0)).alias("aov"),
        zero_if_null("active_customers").cast("long").alias("active_customers"),
    )


def monthly_trend(fct: DataFrame, dim: DataFrame, window: Window, versions: str = "current") -> DataFrame:
    """Revenue and order count per month over **W**, ascending."""
    f = facts_in_window(fct, dim, window, versions)
    trend = f.groupBy(month_start("order_date").alias("month")).agg(
        euro_sum("revenue_euro").alias("revenue"), F.count("order_id").alias("orders")
    )
    return sort_bounded(trend, "month")


def weekly_revenue(fct: DataFrame, dim: DataFrame, window: Window, versions: str = "current") -> DataFrame:
    """Revenue per Monday week over **W**, ascending; empty weeks are absent."""
    f = facts_in_window(fct, dim, window, versions)
    weekly = f.groupBy(week_start("order_date").alias("week")).agg(euro_sum("revenue_euro").alias("revenue"))
    return sort_bounded(weekly, "week")


def date_bounds(fct: DataFrame) -> DataFrame:
    """First and last order date of the fact (G11); the default window."""
    return fct.agg(F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date"))


def product_revenue(
    items: DataFrame,
    products: DataFrame,
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    versions: str = "current",
) -> DataFrame:
    """Item revenue by (product name, category) over **W**.

    The four-way star join is reordered so the big inputs are reduced first:

    1. eligible orders = facts in **W** for the selected customers, counted
       per ``order_id`` (the count keeps inner-join multiplicity exact);
    2. items join the eligible orders on ``order_id`` and are summed per
       ``product_id`` (partial aggregation: a best-selling product never
       moves as raw rows);
    3. only then the per-product totals meet the product dimension and are
       rolled up to (name, category).

    Revenue is ``sum(cents) / 100.0`` as a double, like the reference query.
    """
    eligible = (
        facts_in_window(fct, dim, window, versions).groupBy("order_id").agg(F.count(F.lit(1)).alias("_mult"))
    )
    per_product = (
        items.select("order_id", "product_id", "amount_cents")
        .join(eligible, "order_id")
        .groupBy("product_id")
        .agg(F.sum(F.col("amount_cents") * F.col("_mult")).alias("_cents"))
    )
    return (
        per_product.join(products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_name", "category")
        .agg(cents_sum_to_double("_cents").alias("revenue"))
    )


def product_revenue_from_marts(
    order_products: DataFrame,
    products: DataFrame,
    dim: DataFrame,
    window: Window,
    versions: str = "current",
) -> DataFrame:
    """``product_revenue`` over the (order, product) mart.

    The window prunes the mart's date-ordered files, the customer restriction
    is the same semi join as every other dashboard query, and the per-product
    sum is partially aggregated before its shuffle; no item row is shuffled
    by order.
    """
    per_product = (
        facts_in_window(order_products, dim, window, versions)
        .groupBy("product_id")
        .agg(F.sum("amount_cents").alias("_cents"))
    )
    return (
        per_product.join(products.select("product_id", "product_name", "category"), "product_id")
        .groupBy("product_name", "category")
        .agg(cents_sum_to_double("_cents").alias("revenue"))
    )


def top_n_products(revenue: DataFrame, n: int = 100) -> DataFrame:
    """Top ``n`` (name, category) groups by revenue (O1).

    Ties are broken by name and category so the limit is deterministic; the
    sort + limit plans as a per-partition top-k merged on the driver
    (bounded by ``n``).
    """
    return revenue.orderBy(F.desc("revenue"), F.asc("product_name"), F.asc("category")).limit(n)


def top_products(
    items: DataFrame,
    products: DataFrame,
    fct: DataFrame,
    dim: DataFrame,
    window: Window,
    n: int = 100,
    versions: str = "current",
) -> DataFrame:
    """Top ``n`` (name, category) groups by revenue from raw items (M9, O1)."""
    return top_n_products(product_revenue(items, products, fct, dim, window, versions), n)


def priced_items(items: DataFrame, products: DataFrame, strict: bool = True) -> DataFrame:
    """Attach the unit price of each item's product.

    With ``strict`` an item whose product is unknown fails the job when the
    plan runs (the reference's dictionary lookup raises); otherwise the price
    is null.  The product side is not hinted: the planner broadcasts it only
    under the size threshold.  The result is the final stage, where adaptive
    execution does not split a hot product, so hot products are salted.
    """
    prices = products.select("product_id", F.col("price_cents").alias("unit_price_cents"), F.lit(True).alias("_known"))
    joined = salted_lookup_join(items, prices, "product_id", "left")
    if strict:
        guard = F.when(
            F.col("_known").isNull(),
            F.raise_error(F.concat(F.lit("unknown product_id: "), F.col("product_id").cast("string"))),
        ).otherwise(F.lit(True))
        joined = joined.where(guard)
    return joined.select("order_id", "product_id", "quantity", "amount_cents", "unit_price_cents")


def unknown_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items whose product is missing from the catalogue (anti join)."""
    return items.join(products.select("product_id"), "product_id", "left_anti")
