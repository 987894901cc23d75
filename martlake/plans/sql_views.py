"""The warehouse as SQL views.

Users of the original query the marts with SQL over views named after the
models.  ``register_warehouse_views`` registers the same names over the
materialised marts, so such SQL runs through ``spark.sql`` and Catalyst
plans it exactly like the DataFrame operators (pushdown, pruning, AQE).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martlake.operators.filters import Window
from martlake.plans.warehouse import Marts, Warehouse
from martlake.sources.tables import register_views


def register_warehouse_views(marts: Marts, warehouse: Warehouse) -> None:
    """Temp views ``stg_orders``, ``fct_orders``, ``dim_customers``, ``dim_products``, ``raw_order_items``."""
    register_views(
        {
            "stg_orders": warehouse.stg_orders,
            "fct_orders": marts.fct_orders,
            "dim_customers": marts.dim_customers,
            "dim_products": marts.dim_products,
            "raw_order_items": marts.raw_order_items,
        }
    )


def scope_sql(window: Window) -> str:
    """CTEs ``chosen`` (current customers of the window) and ``scoped`` (their orders in its dates)."""
    wanted = ["is_current"]
    if window.cities:
        wanted.append("city IN (" + ", ".join("'" + city.replace("'", "''") + "'" for city in window.cities) + ")")
    return f"""
        chosen AS (SELECT customer_id FROM dim_customers WHERE {" AND ".join(wanted)}),
        scoped AS (
          SELECT * FROM fct_orders o
          WHERE o.order_date >= DATE '{window.start}' AND o.order_date <= DATE '{window.end}'
            AND EXISTS (SELECT 1 FROM chosen WHERE chosen.customer_id = o.customer_id))"""


def sql_kpi(spark: SparkSession, window: Window) -> DataFrame:
    return spark.sql(
        f"""
        WITH {scope_sql(window)},
        totals AS (
          SELECT count(DISTINCT order_id) AS orders, sum(revenue_euro) AS earned, count(revenue_euro) AS priced,
                 count(DISTINCT customer_id) AS active_customers
          FROM scoped)
        SELECT orders, CAST(ifnull(earned, 0) AS DECIMAL(38,2)) AS revenue,
               ifnull(round(CAST(earned AS DOUBLE) / priced, 6), 0.0) AS aov, active_customers
        FROM totals"""
    )


def sql_monthly_trend(spark: SparkSession, window: Window) -> DataFrame:
    return spark.sql(
        f"""
        WITH {scope_sql(window)},
        dated AS (SELECT trunc(order_date, 'MM') AS month, order_id, revenue_euro FROM scoped)
        SELECT month, CAST(sum(revenue_euro) AS DECIMAL(38,2)) AS revenue, count(order_id) AS orders
        FROM dated GROUP BY month ORDER BY month"""
    )


def sql_top_products(spark: SparkSession, window: Window, n: int = 100) -> DataFrame:
    """Items are summed per order and product, then per product, before they meet the product names."""
    return spark.sql(
        f"""
        WITH {scope_sql(window)},
        sums AS (SELECT order_id, product_id, sum(amount_cents) AS cents FROM raw_order_items GROUP BY order_id, product_id),
        sold AS (
          SELECT product_id, sum(cents) AS cents FROM sums
          WHERE EXISTS (SELECT 1 FROM scoped WHERE scoped.order_id = sums.order_id) GROUP BY product_id)
        SELECT product_name, category, CAST(sum(cents) AS DOUBLE) / 100.0 AS revenue
        FROM sold JOIN dim_products USING (product_id)
        GROUP BY product_name, category
        ORDER BY revenue DESC, product_name, category LIMIT {n}"""
    )
