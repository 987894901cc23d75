from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martlake.session import get_spark  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark(master="local[4]", app_name="martlake-tests", shuffle_partitions=4)
    yield s
    s.stop()


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


FCT_SCHEMA = "order_id string, customer_id long, order_date date, status string, quantity long, revenue_euro decimal(18,2)"
DIM_SCHEMA = (
    "customer_id long, name string, email string, city string, address string, signup_date date, "
    "valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"
)


def make_fct(spark, rows):
    """rows: (order_id, customer_id, 'YYYY-MM-DD', revenue)"""
    from decimal import Decimal

    data = [(o, c, d(day), "completed", 1, Decimal(str(rev))) for o, c, day, rev in rows]
    return spark.createDataFrame(data, FCT_SCHEMA)


def make_dim(spark, rows):
    """rows: (customer_id, city) or (customer_id, city, is_current)"""
    out = []
    for r in rows:
        cid, city = r[0], r[1]
        current = r[2] if len(r) > 2 else True
        valid_to = None if current else dt.datetime(2024, 2, 1)
        out.append((cid, f"n{cid}", f"e{cid}", city, None, d("2020-01-01"), dt.datetime(2024, 1, 1), valid_to, current))
    return spark.createDataFrame(out, DIM_SCHEMA)
