from __future__ import annotations

import pytest

from martlake.operators import quality

T = "id long, fk long, status string, amount double"


def _df(spark):
    # one good row, one bad row, one null per check
    return spark.createDataFrame(
        [(1, 10, "placed", 5.0), (1, 99, "lost", -1.0), (None, None, None, None)],
        T,
    )


def test_each_expectation(spark):
    df = _df(spark)
    parent = spark.createDataFrame([(10,)], "pk long")
    assert [r.id for r in quality.expect_unique(df, "id").collect()] == [1]
    assert quality.expect_not_null(df, "id").count() == 1
    assert [r.status for r in quality.expect_accepted_values(df, "status", ["placed"]).collect()] == ["lost"]
    assert [r.fk for r in quality.expect_relationship(df, "fk", parent, "pk").collect()] == [99]
    assert [r.amount for r in quality.expect_between(df, "amount", 0, 10).collect()] == [-1.0]


def test_each_expectation_passing(spark):
    df = spark.createDataFrame([(1, 10, "placed", 5.0), (None, None, None, None)], T)
    parent = spark.createDataFrame([(10,)], "pk long")
    assert quality.expect_unique(df, "id").count() == 0
    assert quality.expect_accepted_values(df, "status", ["placed"]).count() == 0
    assert quality.expect_relationship(df, "fk", parent, "pk").count() == 0
    assert quality.expect_between(df, "amount", 0, 10).count() == 0


def test_report_and_gate(spark):
    models = {"t": _df(spark), "p": spark.createDataFrame([(10,)], "pk long")}
    checks = [
        quality.Check("unique", "t", "id"),
        quality.Check("not_null", "t", "id"),
        quality.Check("accepted_values", "t", "status", {"values": ["placed"]}),
        quality.Check("relationship", "t", "fk", {"to": "p", "field": "pk"}),
        quality.Check("between", "t", "amount", {"min_value": 0, "max_value": 10}),
    ]
    report = quality.quality_report(models, checks)
    got = {r.check: (r.failures, r.passed) for r in report.collect()}
    assert got == {
        "unique_t_id": (1, False),
        "not_null_t_id": (1, False),
        "accepted_values_t_status": (1, False),
        "relationship_t_fk": (1, False),
        "between_t_amount": (1, False),
    }
    with pytest.raises(quality.QualityGateError):
        quality.enforce(report)


def test_warehouse_checks_pass_on_driver_tables(spark):
    from martlake.plans.catalog import warehouse
    from tests.conftest import SF_SMALL

    rows = quality.enforce(warehouse(spark, SF_SMALL).quality_report())
    assert len(rows) == 12


def test_an_empty_model_passes(spark):
    empty = spark.createDataFrame([], "id long, status string")
    checks = [quality.Check("unique", "m", "id"), quality.Check("not_null", "m", "id"), quality.Check("accepted_values", "m", "status", {"values": ["a"]})]
    rows = quality.enforce(quality.quality_report({"m": empty}, checks))
    assert [(r["failures"], r["passed"]) for r in rows] == [(0, True)] * 3
