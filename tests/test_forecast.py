from __future__ import annotations

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlake.operators import forecast, smoothing_search
from martlake.operators.smoothing_search import GRID, LIMITS, TOLERANCE, search


def _monthly(spark, n, slope=1000.0, intercept=50.0):
    rows = []
    for i in range(n):
        m = dt.date(2020 + i // 12, i % 12 + 1, 1)
        rows.append((m, float(intercept + slope * (m - dt.date(1970, 1, 1)).days)))
    return spark.createDataFrame(rows, "month date, revenue double")


def test_linear_needs_three_points(spark):
    out = forecast.linear_forecast(_monthly(spark, 2))
    assert out.where("type = 'Forecast'").count() == 0
    assert out.where("type = 'Actual'").count() == 2


@pytest.mark.parametrize("n", [3, 12])
def test_linear_exact_line_zero_width_band(spark, n):
    out = forecast.linear_forecast(_monthly(spark, n), digits=6).where("type = 'Forecast'").orderBy("time").collect()
    assert len(out) == 3
    last = dt.date(2020 + (n - 1) // 12, (n - 1) % 12 + 1, 1)
    for h, r in enumerate(out, start=1):
        y, m = divmod(last.month - 1 + h, 12)
        assert r.time == dt.date(last.year + y, m + 1, 1)
        expected = 50.0 + 1000.0 * (r.time - dt.date(1970, 1, 1)).days
        assert math.isclose(r.revenue, expected, rel_tol=1e-9)
        assert math.isclose(r.upper - r.lower, 0.0, abs_tol=1e-3 * abs(expected) * 1e-6 + 1e-3)


def test_linear_per_series_key(spark):
    a = _monthly(spark, 6).selectExpr("'a' AS k", "*")
    b = _monthly(spark, 6, slope=-5.0).selectExpr("'b' AS k", "*")
    out = forecast.linear_forecast(a.unionByName(b), keys=["k"]).where("type = 'Forecast'")
    assert sorted((r.k, r.c) for r in out.groupBy("k").count().withColumnRenamed("count", "c").collect()) == [
        ("a", 3),
        ("b", 3),
    ]


def _weekly(spark, n, season=13, amp=100.0, slope=5.0, key="s"):
    start = dt.date(2020, 1, 6)
    rows = []
    for i in range(n):
        y = 1000.0 + slope * i + amp * math.sin(2 * math.pi * (i % season) / season)
        rows.append((key, start + dt.timedelta(days=7 * i), y))
    return spark.createDataFrame(rows, "k string, week date, revenue double")


def test_season_rules():
    assert forecast.auto_season(11) is None
    assert forecast.auto_season(12) == 12
    assert forecast.auto_season(30) == 13
    assert forecast.auto_season(53) == 52
    assert forecast.choose_season(53, 52) is None  # needs two full cycles
    assert forecast.choose_season(104, 52) == 52
    assert forecast.choose_season(30, 1) is None


@pytest.mark.parametrize("n,expect_rows,model", [(11, 0, None), (12, 12, "trend"), (53, 12, "trend"), (104, 12, "trend+season")])
def test_holt_winters_lengths(spark, n, expect_rows, model):
    out = forecast.holt_winters_forecast(_weekly(spark, n, season=52), keys=["k"]).where("type = 'Forecast'")
    rows = out.collect()
    assert len(rows) == expect_rows
    if rows:
        assert {r.model for r in rows} == {model}


def test_holt_winters_recovers_trend_and_season(spark):
    n, season = 104, 13
    out = (
        forecast.holt_winters_forecast(_weekly(spark, n, season=season), keys=["k"], season=season, horizon=13)
        .where("type = 'Forecast'")
        .orderBy("time")
        .collect()
    )
    assert len(out) == 13
    for h, r in enumerate(out, start=1):
        i = n - 1 + h
        truth = 1000.0 + 5.0 * i + 100.0 * math.sin(2 * math.pi * (i % season) / season)
        assert abs(r.revenue - truth) < 15.0
        assert r.time == dt.date(2020, 1, 6) + dt.timedelta(days=7 * i)
        assert r.lower <= r.revenue <= r.upper


def test_holt_winters_many_series_in_parallel(spark):
    df = _weekly(spark, 30, key="a").unionByName(_weekly(spark, 40, key="b")).unionByName(_weekly(spark, 5, key="c"))
    counts = {
        r.k: r["count"] for r in forecast.holt_winters_forecast(df, keys=["k"]).where("type = 'Forecast'").groupBy("k").count().collect()
    }
    assert counts == {"a": 12, "b": 12}


def test_holt_winters_parameter_ranges(spark):
    df = _weekly(spark, 20)
    with pytest.raises(ValueError):
        forecast.holt_winters_forecast(df, keys=["k"], horizon=3)
    with pytest.raises(ValueError):
        forecast.holt_winters_forecast(df, keys=["k"], season=300)


def test_fill_gaps(spark):
    df = _weekly(spark, 30).where("week <> date'2020-02-03'")
    out = forecast.holt_winters_forecast(df, keys=["k"], fill_gaps=True).where("type = 'Forecast'").orderBy("time").collect()
    assert len(out) == 12
    assert np.isfinite([r.revenue for r in out]).all()
    filled = _weekly(spark, 30).withColumn("revenue", F.when(F.col("week") == dt.date(2020, 2, 3), 0.0).otherwise(F.col("revenue")))
    same = forecast.holt_winters_forecast(filled, keys=["k"]).where("type = 'Forecast'").orderBy("time").collect()
    assert [r.revenue for r in same] == [r.revenue for r in out]


def _plain_holt_winters(y, a, b, g, m, horizon):
    if m:
        level, trend = sum(y[:m]) / m, (sum(y[m : 2 * m]) / m - sum(y[:m]) / m) / m
        seas = [v - level for v in y[:m]]
    else:
        level, trend, seas = y[0], y[1] - y[0], []
    errs = []
    for t, v in enumerate(y):
        s = seas[t % m] if m else 0.0
        errs.append(v - (level + trend + s))
        new = a * (v - s) + (1 - a) * (level + trend)
        trend = b * (new - level) + (1 - b) * trend
        if m:
            seas[t % m] = g * (v - new) + (1 - g) * s
        level = new
    n = len(y)
    return [level + h * trend + (seas[(n + h - 1) % m] if m else 0.0) for h in range(1, horizon + 1)], float(np.std(errs)), sum(e * e for e in errs)


@pytest.mark.parametrize("season", [None, 13])
def test_fixed_parameters_follow_the_recursion(spark, season):
    rows = _weekly(spark, 40).collect()
    noise = np.random.default_rng(1).normal(0, 20, 40)
    df = spark.createDataFrame([(r.k, r.week, r.revenue + float(e)) for r, e in zip(rows, noise)], "k string, week date, revenue double")
    y = [r.revenue for r in df.orderBy("week").collect()]
    want, se, _ = _plain_holt_winters(y, 0.3, 0.2, 0.4, season or 0, 8)
    out = forecast.holt_winters_fixed(df, 0.3, 0.2, 0.4, keys=["k"], horizon=8, season=season).where("type = 'Forecast'").orderBy("time").collect()
    assert np.allclose([r.revenue for r in out], want)
    assert np.allclose([r.upper - r.revenue for r in out], 1.96 * se)


def _plain_search(y, m):
    """The search for one series, a point at a time."""
    error = lambda p: _plain_holt_winters(list(y), *p, m, 1)[2]
    best = min(itertools.product(GRID, GRID, GRID if m else [0.0]), key=error)
    widest = (GRID[1] - GRID[0]) / 2
    least, step = error(best), widest
    while step > TOLERANCE:
        around = [np.clip([x - step, x, x + step], *LIMITS) for x in best]
        if not m:
            around[2] = [0.0]
        point = min(itertools.product(*around), key=error)
        if error(point) < least:
            best, least, step = point, error(point), min(2 * step, widest)
        else:
            step /= 2
    return (*best, least)


def _noisy(n, m, seed):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return 1000 + rng.normal(0, 5) * t + rng.uniform(0, 150) * np.sin(2 * np.pi * t / (m or 9)) + rng.normal(0, 30, n)


def test_search_of_many_series_equals_the_plain_one():
    shapes = [(30, 13), (41, 13), (26, 13), (24, 12), (25, 12), (12, 0), (23, 0), (40, 0), (30, 13), (60, 4)]
    series = [_noisy(n, m, i) for i, (n, m) in enumerate(shapes)]
    found = search(series, [m for _, m in shapes])
    for y, (_, m), got in zip(series, shapes, found, strict=True):
        want = _plain_search(y, m)
        assert np.allclose(got[:3], want[:3], atol=1e-9) and np.isclose(got[3], want[3])


def test_search_reaches_a_minimum(monkeypatch):
    y = _noisy(60, 13, 2)
    (a, b, g, error), *_ = whole = search([y] * 5, [13] * 5)
    assert np.isclose(error, _plain_holt_winters(list(y), a, b, g, 13, 1)[2])
    for step in np.array([[1, 0, 0], [0, 1, 0], [0, 0, 1]]) * 2 * TOLERANCE:
        for sign in (-1, 1):
            p = np.clip(np.array([a, b, g]) + sign * step, *LIMITS)
            assert _plain_holt_winters(list(y), *p, 13, 1)[2] >= error * (1 - 1e-6)
    monkeypatch.setattr(smoothing_search, "TOGETHER", 2)
    assert np.array_equal(search([y] * 5, [13] * 5), whole)


def test_series_are_searched_in_all_tasks(spark):
    weeks = F.explode(F.sequence(F.lit(0), F.lit(39))).alias("t")
    rows = spark.range(100).select("id", weeks).select(
        "id", F.date_add(F.lit("2020-01-06").cast("date"), 7 * F.col("t")).alias("week"), (F.rand(1) * 100 + F.col("t")).alias("revenue")
    )
    arrays, keys = forecast._series_arrays(rows, "week", "revenue", ["id"], "auto", False)
    found = forecast.fitted(arrays, keys)
    counts = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(counts) == 100 and len(counts) == spark.sparkContext.defaultParallelism and max(counts) < 50


def test_fit_of_no_series(spark):
    out = forecast.holt_winters_forecast(_weekly(spark, 30).limit(0), keys=["k"])
    assert out.collect() == []


def test_series_without_values_are_left_out(spark):
    good = _weekly(spark, 30)
    none = _weekly(spark, 30, key="none").withColumn("revenue", F.lit(None).cast("double"))
    out = forecast.holt_winters_forecast(good.unionByName(none), keys=["k"])
    assert {r.k for r in out.where("type = 'Forecast'").collect()} == {"s"}
