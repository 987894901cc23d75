"""Property tests: operators against brute-force Python models on generated inputs."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from martlake.operators import cohort, metrics, scd2
from martlake.operators.filters import Window
from tests.conftest import make_dim, make_fct

SETTINGS = settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
CUST = "customer_id long, city string, segment string"

deliveries = st.lists(
    st.dictionaries(
        st.integers(0, 6),
        st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["x", None])),
        min_size=1,
        max_size=6,
    ),
    min_size=1,
    max_size=3,
)


def brute_history(batches):
    history = []
    for i, rows in enumerate(batches):
        ts = dt.datetime(2024, 1 + i, 1)
        open_rows = {h["id"]: h for h in history if h["to"] is None}
        for key, attrs in rows.items():
            cur = open_rows.get(key)
            if cur is not None and cur["attrs"] == attrs:
                continue
            if cur is not None:
                cur["to"] = ts
            history.append({"id": key, "attrs": attrs, "from": ts, "to": None})
    return sorted(((h["id"], *h["attrs"], h["from"], h["to"]) for h in history), key=repr)


@SETTINGS
@given(batches=deliveries)
def test_scd2_matches_brute_force(spark, batches):
    snap = None
    for i, rows in enumerate(batches):
        data = [(k, c, s) for k, (c, s) in rows.items()]
        snap = scd2.snapshot(spark.createDataFrame(data, CUST), "customer_id", dt.datetime(2024, 1 + i, 1), snap)
    got = sorted(
        ((r.customer_id, r.city, r.segment, r.valid_from, r.valid_to) for r in snap.collect()), key=repr
    )
    assert got == brute_history(batches)


orders = st.lists(
    st.tuples(st.integers(1, 4), st.integers(0, 75), st.integers(0, 27), st.integers(0, 500)),
    min_size=1,
    max_size=25,
)


def _month(offset: int) -> dt.date:
    y, m = divmod(offset, 12)
    return dt.date(2020 + y, m + 1, 1)


def _fixture(spark, rows):
    data = [(f"o{i}", c, str(_month(mo) + dt.timedelta(days=day)), rev) for i, (c, mo, day, rev) in enumerate(rows)]
    return make_fct(spark, data), make_dim(spark, [(c, "City A") for c in range(1, 5)])


ALL = Window.of("2019-01-01", "2030-12-31")


@SETTINGS
@given(rows=orders)
def test_cohort_matches_brute_force(spark, rows):
    fct, dim = _fixture(spark, rows)
    first = {}
    active = defaultdict(set)
    for c, mo, _day, _rev in rows:
        first[c] = min(first.get(c, mo), mo)
        active[c].add(mo)
    cells = defaultdict(set)
    for c, months in active.items():
        for mo in months:
            cells[(first[c], mo - first[c])].add(c)
    expected = {}
    for (cm, idx), custs in cells.items():
        users = len(custs) if 0 <= idx <= 60 else 0
        size = len(cells[(cm, 0)])
        expected[(_month(cm).strftime("%Y-%m"), idx)] = (users, size, users / size)
    got = {
        (r.cohort, r.month_index): (r.users, r.cohort_size, r.retention_rate)
        for r in cohort.cohort_retention(fct, dim, ALL).collect()
    }
    assert got == expected


@SETTINGS
@given(rows=orders)
def test_kpi_and_trend_match_brute_force(spark, rows):
    fct, dim = _fixture(spark, rows)
    k = metrics.kpi(fct, dim, ALL).first()
    total = sum(Decimal(r[3]) for r in rows)
    assert (k.orders, k.revenue, k.active_customers) == (len(rows), total, len({r[0] for r in rows}))
    by_month = defaultdict(lambda: [Decimal(0), 0])
    for _c, mo, _day, rev in rows:
        by_month[_month(mo)][0] += Decimal(rev)
        by_month[_month(mo)][1] += 1
    got = [(r.month, r.revenue, r.orders) for r in metrics.monthly_trend(fct, dim, ALL).collect()]
    assert got == [(m, v[0], v[1]) for m, v in sorted(by_month.items())]


@SETTINGS
@given(rows=orders, data=st.data(), index=st.integers(0, 6), windowed=st.booleans())
def test_drilldown_matches_brute_force(spark, rows, data, index, windowed):
    # the cohort month is one of the order months, so most examples have members
    cohort_offset = data.draw(st.sampled_from(sorted({r[1] for r in rows})))
    fct, dim = _fixture(spark, rows)
    lo, hi = _month(10), _month(50)
    window = Window.of(lo, hi) if windowed else None

    def inside(mo, day):
        d = _month(mo) + dt.timedelta(days=day)
        return lo <= d <= hi

    first = {}
    for c, mo, day, _rev in rows:
        if window is None or inside(mo, day):
            first[c] = min(first.get(c, mo), mo)
    members = {c for c, mo in first.items() if mo == cohort_offset}
    expected = sorted(
        (c, f"o{i}") for i, (c, mo, _day, _rev) in enumerate(rows) if c in members and mo == cohort_offset + index
    )
    label = _month(cohort_offset).strftime("%Y-%m")
    got = [
        (r.customer_id, r.order_id)
        for r in cohort.cohort_drilldown(fct, dim, label, index, window=window).collect()
    ]
    assert got == expected[:1000]
