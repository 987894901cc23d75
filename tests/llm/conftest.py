from __future__ import annotations

import duckdb
import pytest

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def tables():
    """Tables of the small data set as lists of dicts."""

    def load(name: str, sf: str = SF) -> list[dict]:
        return duckdb.sql(f"select * from '{sf}/{name}.parquet'").to_arrow_table().to_pylist()

    return load
