"""Every registered query against its DuckDB SQL on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, rows_canon

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["month", "revenue", "orders"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in sdf.collect()]
    res = con.sql(oracle_sql()[name])
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(res.columns)
    assert len(s_rows) == len(d_rows)
    assert rows_canon(sdf.columns, s_rows) == rows_canon(res.columns, d_rows)


def test_clusters_are_nearest_centres_and_repeatable(spark):
    from pyspark.sql import functions as F

    from martlake.operators import segments
    from martlake.plans.catalog import W, marts

    m = marts(spark, SF_SMALL)
    scaled = segments.rfm_scaled(segments.rfm_wide(m.fct_orders, m.dim_customers, W))
    first, second = (segments.rfm_clusters(scaled, 4, seed=42) for _ in range(2))
    rows = {r.customer_id: (r.cluster_a, r.cluster_b) for r in first.collect()}
    assert rows == {r.customer_id: (r.cluster_a, r.cluster_b) for r in second.collect()}
    points = []
    for r in scaled.collect():
        for k, p in enumerate("ab"):
            points.append((rows[r.customer_id][k], [r[f"z_{f}_{p}"] for f in segments.FEATURES]))
    assert len(rows) == scaled.count() == scaled.select(F.col("customer_id")).distinct().count()
    used = sorted({c for c, _ in points})
    centres = {c: [sum(x[i] for d, x in points if d == c) / sum(d == c for d, _ in points) for i in range(3)] for c in used}
    off = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, centres[c]))
    assert all(off(x, c) <= min(off(x, d) for d in used) + 1e-6 for c, x in points)


@pytest.mark.parametrize("name", ["holt_winters_forecast", "holt_winters_by_city", "holt_winters_by_city_category"])
def test_forecast_rows(spark, name):
    rows = queries()[name](spark, SF_SMALL).collect()
    series = {tuple(r[c] for c in r.asDict() if c in ("series", "city", "category")) for r in rows if r.type == "Forecast"}
    assert series and sum(r.type == "Forecast" for r in rows) == 12 * len(series)
    assert all(r.lower <= r.revenue <= r.upper for r in rows if r.type == "Forecast")
