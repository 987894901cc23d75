from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F

from martlake.operators import cohort, metrics
from martlake.operators.filters import Window, city_filter, default_cities, facts_in_window, first_cohorts
from tests.conftest import make_dim, make_fct

W23 = Window.of("2023-01-01", "2023-12-31")


def test_window_bounds_inclusive(spark):
    fct = make_fct(
        spark,
        [("a", 1, "2022-12-31", 1), ("b", 1, "2023-01-01", 1), ("c", 1, "2023-12-31", 1), ("e", 1, "2024-01-01", 1)],
    )
    dim = make_dim(spark, [(1, "City A")])
    got = sorted(r.order_id for r in facts_in_window(fct, dim, W23).collect())
    assert got == ["b", "c"]


def test_empty_city_list_means_no_filter(spark):
    assert city_filter("city", []) is None
    fct = make_fct(spark, [("a", 1, "2023-02-01", 1), ("b", 2, "2023-02-01", 1)])
    dim = make_dim(spark, [(1, "City A"), (2, "City B")])
    assert facts_in_window(fct, dim, W23).count() == 2
    assert facts_in_window(fct, dim, Window.of("2023-01-01", "2023-12-31", ["City B"])).count() == 1


def test_two_versions_default_once_parity_twice(spark):
    fct = make_fct(spark, [("a", 1, "2023-02-01", 10)])
    dim = make_dim(spark, [(1, "City A", False), (1, "City A", True)])
    assert metrics.kpi(fct, dim, W23).first().revenue == Decimal("10.00")
    parity = metrics.kpi(fct, dim, W23, versions="all").first()
    assert parity.revenue == Decimal("20.00") and parity.orders == 1


def test_kpi_counts_without_expanding_rows(spark):
    fct = make_fct(spark, [("a", 1, "2023-02-01", 10), ("b", 1, "2023-03-01", 5), ("c", 2, "2023-04-01", 7), ("d", 3, "2023-04-01", 9), ("e", 4, "2022-04-01", 9)])
    dim = make_dim(spark, [(1, "City A", False), (1, "City A", True), (2, "City B", True), (4, "City B", True)])
    for versions, want in (("current", (3, Decimal("22.00"), round(22 / 3, 6), 2)), ("all", (3, Decimal("37.00"), 7.4, 2))):
        fast, exact = (metrics.kpi(fct, dim, W23, versions, unique_orders=u) for u in (True, False))
        assert tuple(fast.first()) == tuple(exact.first()) == want
        assert "Expand" not in fast._jdf.queryExecution().executedPlan().toString()
    twice = fct.unionByName(fct)  # order ids that repeat are told apart only on request
    assert metrics.kpi(twice, dim, W23, unique_orders=False).first().orders == 3


def test_kpi_empty_window_is_zero(spark):
    fct = make_fct(spark, [("a", 1, "2023-02-01", 10)])
    dim = make_dim(spark, [(1, "City A")])
    r = metrics.kpi(fct, dim, Window.of("2020-01-01", "2020-12-31")).first()
    assert (r.orders, r.revenue, r.aov, r.active_customers) == (0, Decimal("0.00"), 0.0, 0)


def test_kpi_revenue_equals_sum_of_trend(spark):
    from tests.conftest import SF_SMALL
    from martlake.plans.catalog import W, warehouse

    wh = warehouse(spark, SF_SMALL)
    k = metrics.kpi(wh.fct_orders, wh.dim_customers, W).first()
    t = metrics.monthly_trend(wh.fct_orders, wh.dim_customers, W).agg(F.sum("revenue"), F.sum("orders")).first()
    assert k.revenue == t[0]
    assert k.orders == t[1]


def test_cohort_month_boundary_and_clamp(spark):
    # same customer: Jan 31, Feb 1, and 61 months later
    fct = make_fct(spark, [("a", 1, "2023-01-31", 1), ("b", 1, "2023-02-01", 1), ("c", 1, "2028-02-15", 1)])
    dim = make_dim(spark, [(1, "City A")])
    rows = {r.month_index: r for r in cohort.cohort_retention(fct, dim, Window.of("2023-01-01", "2030-01-01")).collect()}
    assert sorted(rows) == [0, 1, 61]
    assert rows[0].users == 1 and rows[1].users == 1
    assert rows[61].users == 0  # beyond 60: kept with 0 users
    assert rows[0].retention_rate == 1.0 and rows[61].retention_rate == 0.0
    assert rows[0].cohort == "2023-01"


def test_cohort_invariants_on_driver_tables(spark):
    from tests.conftest import SF_SMALL
    from martlake.plans.catalog import W_ALL, warehouse

    wh = warehouse(spark, SF_SMALL)
    c = cohort.cohort_retention(wh.fct_orders, wh.dim_customers, W_ALL)
    zero = c.where(F.col("month_index") == 0)
    assert zero.where(F.col("retention_rate") != 1.0).count() == 0
    # cohort sizes add up to the number of active customers
    total = zero.agg(F.sum("users")).first()[0]
    assert total == metrics.kpi(wh.fct_orders, wh.dim_customers, W_ALL).first().active_customers
    span = Window.of("1995-01-01", "1996-12-31")
    c = cohort.cohort_retention(wh.fct_orders, wh.dim_customers, span)
    m = cohort.cohort_matrix(c, span)
    assert m.count() == c.select("cohort").distinct().count()
    assert m.columns == ["cohort"] + [f"m{i}" for i in range(24)]
    cells = {(r.cohort, r.month_index): r.retention_rate for r in c.collect()}
    for r in m.collect():
        assert [r[f"m{i}"] for i in range(24)] == [cells.get((r.cohort, i), 0.0) for i in range(24)]


def test_first_cohorts_keeps_oldest(spark):
    df = spark.createDataFrame([(f"2023-{m:02d}", 0, 1.0) for m in range(1, 10)], "cohort string, month_index long, retention_rate double")
    got = sorted(r.cohort for r in first_cohorts(df, 3).collect())
    assert got == ["2023-01", "2023-02", "2023-03"]


def test_drilldown_uses_whole_history_by_default(spark):
    fct = make_fct(
        spark,
        [("a", 1, "2023-01-10", 5), ("b", 1, "2023-03-02", 6), ("c", 2, "2023-02-01", 7), ("d", 2, "2023-03-09", 8)],
    )
    dim = make_dim(spark, [(1, "City A"), (2, "City A")])
    got = [(r.customer_id, r.order_id) for r in cohort.cohort_drilldown(fct, dim, "2023-01", 2).collect()]
    assert got == [(1, "b")]
    windowed = cohort.cohort_drilldown(fct, dim, "2023-02", 1, window=Window.of("2023-02-01", "2023-12-31"))
    assert sorted(r.order_id for r in windowed.collect()) == ["d"]
    assert windowed.columns == ["customer_id", "order_id", "revenue_euro", "order_date"]


def test_top_products_merge_and_tie_break(spark):
    fct = make_fct(spark, [("o1", 1, "2023-02-01", 0), ("o2", 1, "2023-02-02", 0)])
    dim = make_dim(spark, [(1, "City A")])
    items = spark.createDataFrame(
        [("o1", 1, 1, 100), ("o1", 2, 1, 200), ("o2", 3, 1, 300)],
        "order_id string, product_id long, quantity long, amount_cents long",
    )
    prods = spark.createDataFrame(
        [(1, "Alpha", "X"), (2, "Alpha", "X"), (3, "Beta", "X")], "product_id long, product_name string, category string"
    )
    got = [tuple(r) for r in metrics.top_products(items, prods, fct, dim, W23, n=2).collect()]
    assert got == [("Alpha", "X", 3.0), ("Beta", "X", 3.0)]


def test_default_cities(spark):
    dim = make_dim(spark, [(i, f"C{i}") for i in range(7)])
    assert [r.city for r in default_cities(dim).collect()] == ["C0", "C1", "C2", "C3", "C4"]
    assert [r.city for r in default_cities(dim, ["C6", "Nowhere"]).collect()] == ["C6"]
