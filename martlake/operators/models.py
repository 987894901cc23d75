"""Warehouse models: staging view, dimensions and the order fact.

Each model is a lazy DataFrame function; materialisation (view or table) is
the caller's choice (S4/S5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlake.functions.columns import is_current, zero_if_null
from martlake.functions.dates import to_date_ntz
from martlake.functions.money import cents_to_euros, margin_euros

# Attributes of the customer dimension as declared by the warehouse model.
# ``address`` is not produced by the raw writer; absent attributes become typed
# nulls (defect D2), so the list is a parameter.
DIM_CUSTOMER_ATTRIBUTES = ("name", "email", "city", "address", "signup_date")


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    """Staging orders (M1): rename/select and cast the order timestamp to a date."""
    return raw_orders.select(
        "order_id",
        "customer_id",
        "status",
        to_date_ntz("order_date").alias("order_date"),
    )


def dim_products(raw_products: DataFrame, margin_mode: str = "correct") -> DataFrame:
    """Product dimension (M2) with euro prices and the margin.

    ``margin_mode="reference"`` reproduces defect D1 for parity runs.
    """
    return raw_products.select(
        "product_id",
        "product_name",
        "category",
        cents_to_euros("price_cents").alias("price_euro"),
        cents_to_euros("cost_cents").alias("cost_euro"),
        margin_euros("price_cents", "cost_cents", mode=margin_mode).alias("margin_euro"),
    )


def order_totals(raw_order_items: DataFrame) -> DataFrame:
    """Items per order and total cents (G1).

    The item ``quantity`` is deliberately not used (defect D4 kept as the
    defined metric).  Partial aggregation runs before the shuffle, so an order
    with very many items never moves as raw rows.
    """
    return raw_order_items.groupBy("order_id").agg(
        F.count("product_id").alias("num_items"),
        F.sum("amount_cents").alias("total_revenue_cents"),
    )


def order_pairs(raw_order_items: DataFrame) -> DataFrame:
    """Items and cents of each product in each order.

    An order rarely holds a product twice, so sums before the shuffle would hold
    a row for nearly each item of a task's input and spill them. Items are dealt
    by order and product as they are, which spreads a hot order over its products
    and a hot product over its orders.
    """
    items = raw_order_items.select("order_id", "product_id", "amount_cents").repartition("order_id", "product_id")
    return items.groupBy("order_id", "product_id").agg(
        F.sum("amount_cents").alias("amount_cents"), F.count(F.lit(1)).alias("items")
    )


def pair_totals(pairs: DataFrame) -> DataFrame:
    """``order_totals`` of the items that ``order_pairs`` summed."""
    return pairs.groupBy("order_id").agg(
        F.sum(F.when(F.col("product_id").isNotNull(), F.col("items")).otherwise(0)).alias("num_items"),
        F.sum("amount_cents").alias("total_revenue_cents"),
    )


def fct_orders(stg: DataFrame, raw_order_items: DataFrame) -> DataFrame:
    """Order fact (M4): one row per staged order, items pre-aggregated.

    Orders without items keep quantity 0 and revenue 0.00.
    """
    return fct_of_totals(stg, order_totals(raw_order_items))


def fct_of_totals(stg: DataFrame, totals: DataFrame) -> DataFrame:
    """The order fact from staged orders and the totals of their items.

    The per-order totals grow with the fact itself (one row per order), so the
    join is pinned to a shuffle sort-merge join: a size estimate of a filtered
    or small sample must never turn it into a broadcast of a fact-sized table.
    Both sides end up hash-partitioned on ``order_id``; the aggregate's output
    partitioning is reused by the join, so the fact costs two exchanges.
    """
    return stg.join(totals.hint("merge"), "order_id", "left").select(
        "order_id",
        "customer_id",
        "order_date",
        "status",
        zero_if_null("num_items").cast("long").alias("quantity"),
        cents_to_euros(zero_if_null("total_revenue_cents")).alias("revenue_euro"),
    )


def dim_customers(snapshot: DataFrame, attributes: Sequence[str] = DIM_CUSTOMER_ATTRIBUTES) -> DataFrame:
    """Customer dimension over the type-2 history."""
    present = set(snapshot.columns)
    cols = [F.col("customer_id")]
    for name in attributes:
        cols.append(F.col(name) if name in present else F.lit(None).cast("string").alias(name))
    cols += [
        F.col("valid_from"),
        F.col("valid_to"),
        is_current("valid_to").alias("is_current"),
    ]
    return snapshot.select(*cols)


def order_product_facts(pairs: DataFrame, fct: DataFrame) -> DataFrame:
    """Item revenue per (order, product) with the order's customer and date.

    The product ranking (M9) joins items with the order fact; materialised
    once as a mart, that join no longer runs per query and the order date
    lets a window prune item rows.  ``pairs`` are the items summed by
    ``order_pairs``; the inner join keeps the original join's multiplicity.
    """
    return pairs.join(fct.select("order_id", "customer_id", "order_date"), "order_id").select(
        "order_id", "product_id", "customer_id", "order_date", "amount_cents", "items"
    )
