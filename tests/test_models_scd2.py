from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlake.operators import models, scd2
from tests.conftest import d

CUST = "customer_id long, name string, city string, segment string"
B1, B2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def test_fct_orders_keeps_orders_without_items(spark):
    orders = spark.createDataFrame(
        [("o1", 1, dt.datetime(2023, 1, 5), "completed"), ("o2", 2, dt.datetime(2023, 1, 6, 23, 59), "placed")],
        "order_id string, customer_id long, order_date timestamp_ntz, status string",
    )
    items = spark.createDataFrame(
        [("o1", 10, 2, 1050), ("o1", 11, 1, 5)], "order_id string, product_id long, quantity long, amount_cents long"
    )
    fct = models.fct_orders(models.stg_orders(orders), items)
    rows = {r.order_id: r for r in fct.collect()}
    assert rows["o1"].quantity == 2 and str(rows["o1"].revenue_euro) == "10.55"
    assert rows["o2"].quantity == 0 and str(rows["o2"].revenue_euro) == "0.00"
    assert rows["o2"].order_date == d("2023-01-06")  # no time-zone shift
    assert dict(fct.dtypes)["revenue_euro"] == "decimal(18,2)"


def test_dim_products_margin_modes(spark):
    raw = spark.createDataFrame(
        [(1, "A", "X", 5000, 3000)], "product_id long, product_name string, category string, price_cents long, cost_cents long"
    )
    assert str(models.dim_products(raw).first().margin_euro) == "20.00"
    assert str(models.dim_products(raw, "reference").first().margin_euro) == "4970.00"


def test_dim_customers_absent_attribute_is_typed_null(spark):
    snap = scd2.snapshot(spark.createDataFrame([(1, "a", "B", "S")], CUST), "customer_id", B1)
    dim = models.dim_customers(snap, ["name", "city", "address"])
    assert dict(dim.dtypes)["address"] == "string"
    r = dim.first()
    assert r.address is None and r.is_current


def _hist(df):
    return sorted(((r.customer_id, r.city, r.segment, r.valid_from, r.valid_to) for r in df.collect()), key=repr)


def test_snapshot_first_load_all_open(spark):
    inc = spark.createDataFrame([(1, "a", "B", "S"), (2, "b", "M", None)], CUST)
    snap = scd2.snapshot(inc, "customer_id", B1)
    assert _hist(snap) == sorted([(1, "B", "S", B1, None), (2, "M", None, B1, None)], key=repr)
    assert snap.where(F.col("scd_id").isNull()).count() == 0


def test_snapshot_five_cases(spark):
    first = spark.createDataFrame(
        [(1, "a", "B", "S"), (2, "b", "M", "S"), (3, "c", "H", "S"), (4, "d", "K", None)], CUST
    )
    snap1 = scd2.snapshot(first, "customer_id", B1)
    # 1 unchanged, 2 changed city, 3 absent, 4 null -> value, 5 new
    second = spark.createDataFrame(
        [(1, "a", "B", "S"), (2, "b", "X", "S"), (4, "d", "K", "V"), (5, "e", "B", "S")], CUST
    )
    snap2 = scd2.snapshot(second, "customer_id", B2, previous=snap1)
    expected = [
        (1, "B", "S", B1, None),
        (2, "M", "S", B1, B2),
        (2, "X", "S", B2, None),
        (3, "H", "S", B1, None),
        (4, "K", None, B1, B2),
        (4, "K", "V", B2, None),
        (5, "B", "S", B2, None),
    ]
    assert _hist(snap2) == sorted(expected, key=repr)
    # value -> null is a change as well
    third = second.withColumn("segment", F.when(F.col("customer_id") == 1, None).otherwise(F.col("segment")))
    snap3 = scd2.snapshot(third, "customer_id", dt.datetime(2024, 3, 1), previous=snap2)
    assert snap3.where((F.col("customer_id") == 1)).count() == 2
    _assert_history_invariants(snap3)


def test_snapshot_rerun_is_idempotent(spark):
    first = spark.createDataFrame([(1, "a", "B", "S"), (2, "b", "M", "S")], CUST)
    second = spark.createDataFrame([(1, "a", "B", "T"), (2, "b", "M", "S")], CUST)
    snap1 = scd2.snapshot(first, "customer_id", B1)
    snap2 = scd2.snapshot(second, "customer_id", B2, previous=snap1)
    again = scd2.snapshot(second, "customer_id", B2, previous=snap2)
    assert _hist(again) == _hist(snap2)


def test_snapshot_rejects_duplicate_keys(spark):
    snap1 = scd2.snapshot(spark.createDataFrame([(1, "a", "B", "S")], CUST), "customer_id", B1)
    dup = spark.createDataFrame([(1, "a", "B", "S"), (1, "a", "C", "S")], CUST)
    with pytest.raises(Exception, match="duplicate snapshot key"):
        scd2.snapshot(dup, "customer_id", B2, previous=snap1).collect()


def test_snapshot_detects_schema_drift(spark):
    snap1 = scd2.snapshot(spark.createDataFrame([(1, "a", "B", "S")], CUST), "customer_id", B1)
    other = spark.createDataFrame([(1, "a", "B")], "customer_id long, name string, city string")
    with pytest.raises(ValueError, match="schema drift"):
        scd2.snapshot(other, "customer_id", B2, previous=snap1)


def _assert_history_invariants(snap):
    open_per_key = snap.where(F.col("valid_to").isNull()).groupBy("customer_id").count()
    assert open_per_key.where(F.col("count") > 1).count() == 0
    rows = sorted((r.customer_id, r.valid_from, r.valid_to) for r in snap.collect())
    by_key: dict[int, list] = {}
    for k, f, t in rows:
        by_key.setdefault(k, []).append((f, t))
    for versions in by_key.values():
        for (f1, t1), (f2, _t2) in zip(versions, versions[1:]):
            assert t1 is not None and t1 <= f2  # no overlap


def test_second_load_mapping_on_driver_tables(spark):
    from martlake.plans.catalog import second_snapshot
    from tests.conftest import SF_SMALL

    snap = second_snapshot(spark, SF_SMALL)
    _assert_history_invariants(snap)
    closed = snap.where(F.col("valid_to").isNotNull())
    # only the city (id % 10 == 0) and segment (id % 10 == 2) changes close a row
    assert closed.where(~(F.col("customer_id") % 10).isin(0, 2)).count() == 0


def test_null_and_duplicate_keys_fail_every_delivery(spark):
    schema = "id long, name string"
    good = spark.createDataFrame([(1, "a")], schema)
    history = scd2.snapshot(good, "id", "2024-01-01")
    for rows, said in (([(1, "a"), (None, "x")], "null snapshot key"), ([(1, "a"), (1, "b")], "duplicate snapshot key")):
        bad = spark.createDataFrame(rows, schema)
        for df in (scd2.snapshot(bad, "id", "2024-01-01"), scd2.snapshot(bad, "id", "2024-02-01", history)):
            with pytest.raises(Exception, match=said):
                df.collect()


def test_open_rows_without_a_key_stay(spark):
    history = scd2.snapshot(spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string"), "id", "2024-01-01")
    history = history.withColumn("id", F.when(F.col("id") == 2, F.lit(None)).otherwise(F.col("id")))
    merged = scd2.snapshot(spark.createDataFrame([(1, "a")], "id long, name string"), "id", "2024-02-01", history)
    assert sorted(r.name for r in merged.collect()) == ["a", "b"]


def test_items_are_not_summed_before_they_are_dealt(spark):
    rows = [("1", 7, 1, 100), ("1", 7, 2, 50), ("1", 8, 1, 5), ("2", 7, 1, 9), ("2", None, 1, 1), (None, 7, 1, 3), (None, 7, 1, 4)]
    items = spark.createDataFrame(rows, "order_id string, product_id long, quantity long, amount_cents long").repartition(3, "quantity")
    pairs = models.order_pairs(items)
    want = {("1", 7, 150, 2), ("1", 8, 5, 1), ("2", 7, 9, 1), ("2", None, 1, 1), (None, 7, 7, 2)}
    assert {tuple(r) for r in pairs.select("order_id", "product_id", "amount_cents", "items").collect()} == want
    totals = {tuple(r) for r in models.pair_totals(pairs).select("order_id", "num_items", "total_revenue_cents").collect()}
    assert totals == {tuple(r) for r in models.order_totals(items).select("order_id", "num_items", "total_revenue_cents").collect()}
    # sums below the exchange would hold a row for nearly each item of a task's input, and spill them
    top, _, below = pairs._jdf.queryExecution().sparkPlan().toString().partition("Exchange hashpartitioning(order_id")
    assert "Aggregate" in top and below and "Aggregate" not in below
