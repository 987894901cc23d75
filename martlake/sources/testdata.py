"""Map the driver's TPC-H-style tables onto the four raw retail tables.

The mapping is fixed (see FIXTURES.md section 3) and repeated as SQL CTEs in
``martlake.plans.oracle`` so that the DuckDB oracle sees the same raw rows.
Every expression is a built-in column function; the only join is customer to
nation, whose 25-row side the planner broadcasts on its own size estimate.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlake.sources.tables import RAW_SCHEMAS, conform

# Fixed values of the mapping (FIXTURES.md section 3).
SIGNUP_BASE_DATE = "1995-01-01"
SIGNUP_CYCLE_DAYS = 365
EMAIL_PREFIX = "user"
EMAIL_DOMAIN = "@example.com"
COST_NUMERATOR, COST_DENOMINATOR = 6, 10
STATUS_CODES = {"F": "completed", "O": "shipped", "P": "placed"}

# Second customer load for the type-2 history (FIXTURES.md section 3).
NEW_CUSTOMER_OFFSET = 10_000_000_000
NEW_CUSTOMER_EVERY = 75


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_driver_table(spark, sf_dir, "customer")
    n = read_driver_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit(EMAIL_PREFIX), F.col("c_custkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias("email"),
        F.col("n_name").alias("city"),
        F.col("c_mktsegment").alias("segment"),
        F.date_add(F.lit(SIGNUP_BASE_DATE).cast("date"), (F.col("c_custkey") % SIGNUP_CYCLE_DAYS).cast("int")).alias(
            "signup_date"
        ),
    )
    return conform(df, RAW_SCHEMAS["raw_customers"])


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_driver_table(spark, sf_dir, "part")
    price = F.round(F.col("p_retailprice") * 100).cast("long")
    df = p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("price_cents"),
        ((price * COST_NUMERATOR) / COST_DENOMINATOR).cast("long").alias("cost_cents"),
    )
    return conform(df, RAW_SCHEMAS["raw_products"])


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_driver_table(spark, sf_dir, "orders")
    status = F.lit(None).cast("string")
    for code, value in reversed(list(STATUS_CODES.items())):
        status = F.when(F.col("o_orderstatus") == code, value).otherwise(status)
    df = o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_date"),
        status.alias("status"),
    )
    return conform(df, RAW_SCHEMAS["raw_orders"])


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_driver_table(spark, sf_dir, "lineitem")
    df = li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.round(F.col("l_quantity")).cast("long").alias("quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("amount_cents"),
    )
    return conform(df, RAW_SCHEMAS["raw_order_items"])


# the driver's tables that the mapping reads
TABLES = ("customer", "nation", "part", "orders", "lineitem")


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "raw_customers": raw_customers(spark, sf_dir),
        "raw_products": raw_products(spark, sf_dir),
        "raw_orders": raw_orders(spark, sf_dir),
        "raw_order_items": raw_order_items(spark, sf_dir),
    }


def second_customer_load(first: DataFrame) -> DataFrame:
    """Derive the second customer delivery from the first (FIXTURES.md section 3).

    ``id % 10 == 0``: city moves to the next nation number (mod 25);
    ``id % 10 == 1``: row absent; ``id % 10 == 2``: segment becomes null;
    every 75th id (``id % 75 == 3``) also arrives as a new customer with id
    + 10,000,000,000.  Everything else is identical.  Row-wise only: no shuffle.
    """
    key = F.col("customer_id")
    city_num = F.regexp_extract(F.col("city"), r"(\d+)$", 1).cast("int")
    moved_city = F.concat(F.lit("NATION_"), ((city_num + 1) % 25).cast("string"))
    kept = first.where((key % 10) != 1).select(
        "customer_id",
        "name",
        "email",
        F.when((key % 10) == 0, moved_city).otherwise(F.col("city")).alias("city"),
        F.when((key % 10) == 2, F.lit(None).cast("string")).otherwise(F.col("segment")).alias("segment"),
        "signup_date",
    )
    new = first.where((key % NEW_CUSTOMER_EVERY) == 3).withColumn("customer_id", key + F.lit(NEW_CUSTOMER_OFFSET))
    return kept.unionByName(new)
