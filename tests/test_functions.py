from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from martlake.functions.columns import safe_ratio
from martlake.functions.dates import (
    date_dimension,
    label_to_month,
    month_distance,
    month_label,
    month_start,
    week_start,
    window_split_day,
)
from martlake.functions.labels import cell_label, currency_label, euro_2dp_label, grouped_int_label, percent_label
from martlake.functions.money import cents_to_euros, margin_euros
from tests.conftest import d


def test_cents_to_euros_exact(spark):
    df = spark.createDataFrame([(105,), (12345678901,), (0,)], "c long")
    got = [str(r[0]) for r in df.select(cents_to_euros("c")).collect()]
    assert got == ["1.05", "123456789.01", "0.00"]


def test_margin_correct_and_reference_mode(spark):
    df = spark.createDataFrame([(5000, 3000)], "p long, c long")
    row = df.select(
        margin_euros("p", "c").alias("ok"), margin_euros("p", "c", mode="reference").alias("parity")
    ).first()
    assert str(row.ok) == "20.00"
    assert str(row.parity) == "4970.00"


def test_safe_ratio_zero_and_null(spark):
    df = spark.createDataFrame([(3, 0), (3, None), (1, 4)], "n long, d long")
    got = [r[0] for r in df.select(safe_ratio("n", "d")).collect()]
    assert got == [0.0, None, 0.25]


def test_month_distance_counts_boundaries(spark):
    df = spark.createDataFrame([(d("2023-01-31"), d("2023-02-01")), (d("2023-01-31"), d("2028-02-01"))], "a date, b date")
    got = [r[0] for r in df.select(month_distance("a", "b")).collect()]
    assert got == [1, 61]


def test_truncation_and_labels(spark):
    df = spark.createDataFrame([(d("2023-01-01"),)], "x date")
    r = df.select(
        month_start("x").alias("m"), week_start("x").alias("w"), month_label("x").alias("l")
    ).first()
    assert r.m == d("2023-01-01")
    assert r.w == d("2022-12-26")  # Monday
    assert r.l == "2023-01"
    back = spark.createDataFrame([("2023-07",)], "l string").select(label_to_month("l")).first()[0]
    assert back == d("2023-07-01")


def test_window_split_day():
    assert window_split_day(d("2023-01-01"), d("2023-12-31")) == d("2023-07-02")
    assert window_split_day(d("2023-01-01"), d("2023-01-01")) == d("2023-01-02")


def test_currency_label_cases(spark):
    values = ["-5", "0", "999.99", "1000", "1000000", "1000000000", None, "text", "1234567.0"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(currency_label("v")).collect()]
    assert got == ["€-5.00", "€0.00", "€999.99", "€1K", "€1.0M", "€1.00B", "€0", "€0", "€1.2M"]


def test_kpi_and_cell_labels(spark):
    df = spark.createDataFrame([(12345, 35.5, 0.125, 7)], "n long, aov double, share double, users long")
    r = df.select(
        grouped_int_label("n").alias("g"),
        euro_2dp_label("aov").alias("e"),
        percent_label("share").alias("p"),
        cell_label("users", "share").alias("c"),
    ).first()
    assert r.g == "12,345"
    assert r.e == "€35.50"
    assert r.p in ("12.5%",)
    assert r.c == "7 users\n12.5%"


def _python_currency(v: float) -> str:
    # the original's rules written with Python formatting, as the model to match
    if v >= 1e9:
        return f"€{v / 1e9:.2f}B"
    if v >= 1e6:
        return f"€{v / 1e6:.1f}M"
    if v >= 1e3:
        return f"€{v / 1e3:.0f}K"
    return f"€{v:,.2f}"


def test_labels_round_like_python_on_ties(spark):
    # exact binary ties (0.5, 12344.5) round half to even; near-ties (2.675,
    # 1.005) round by their exact binary value
    values = [0.5, 1.5, 2.5, 2.675, 1.005, 0.125, 0.375, 7.45, 99.995, 12344.5, 12345.5, 1234.5, 2500.5,
              3500.0, 1_234_567.125, 2_250_000.0, 2_350_000.0, 1_005_000_000.0, 0.0449999, 0.33333, 1 / 3, 2 / 3]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select(
        "v",
        currency_label("v").alias("cur"),
        euro_2dp_label("v").alias("e"),
        percent_label(F.col("v") / 100.0).alias("p"),
        cell_label(F.lit(3), "v").alias("c"),
    ).collect()
    for r in rows:
        v = r.v
        assert r.cur == _python_currency(v), v
        assert r.e == f"€{v:.2f}", v
        share = v / 100.0
        assert r.p == str(float(np.round(share * 100, 1))) + "%", v
        assert r.c == f"3 users\n{v:.1%}", v


def test_date_dimension_matches_seed(spark):
    bounds = spark.createDataFrame([(d("2024-01-01"), d("2024-01-05"))], "start_date date, end_date date")
    got = [tuple(r) for r in date_dimension(bounds).orderBy("date_day").collect()]
    # The five rows of the original calendar seed.
    seed = [
        (20240101, d("2024-01-01"), 2024, 1, "January", 1, 1, "Monday"),
        (20240102, d("2024-01-02"), 2024, 1, "January", 2, 1, "Tuesday"),
        (20240103, d("2024-01-03"), 2024, 1, "January", 3, 1, "Wednesday"),
        (20240104, d("2024-01-04"), 2024, 1, "January", 4, 1, "Thursday"),
        (20240105, d("2024-01-05"), 2024, 1, "January", 5, 1, "Friday"),
    ]
    assert got == seed


def test_date_dimension_overlapping_ranges_deduplicated(spark):
    bounds = spark.createDataFrame(
        [(d("2024-01-01"), d("2024-01-03")), (d("2024-01-02"), d("2024-01-04"))], "s date, e date"
    )
    assert date_dimension(bounds, "s", "e").count() == 4


def test_currency_labels_without_a_finite_amount(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, float("inf")), (3, float("-inf")), (4, None)], "id int, v double")
    got = {r.id: r.label for r in df.select("id", currency_label("v").alias("label")).collect()}
    assert got == {1: "€nan", 2: "€infB", 3: "€-inf", 4: "€0"}
