"""Data-quality checks.

Each ``expect_*`` returns the failing rows as a lazy DataFrame, like a data
test that selects violations.  ``quality_report`` scans each model once:
row-level checks (not null, accepted values, range) are counted inside the
aggregation of the model's uniqueness check; relationship checks add one
anti-join each; the one-row results are unioned: one DataFrame, no driver
loop over data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def expect_unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` occurring more than once; nulls ignored (Q1)."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .where(F.col("n_records") > 1)
    )


def expect_not_null(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null (Q2)."""
    return df.where(F.col(col).isNull())


def expect_accepted_values(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Rows whose ``col`` is not in ``values``; nulls pass (Q3)."""
    return df.where(~F.col(col).isin(list(values)))


def expect_relationship(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null key has no parent (Q4, J9): a left-anti join."""
    keys = parent.select(F.col(pk).alias("_pk"))
    return child.where(F.col(fk).isNotNull()).join(keys, F.col(fk) == F.col("_pk"), "left_anti")


def expect_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Rows with ``col`` outside ``[lo, hi]``; nulls pass (Q5)."""
    return df.where(~F.col(col).between(lo, hi))


@dataclass(frozen=True)
class Check:
    """One declared test: ``kind`` is unique, not_null, accepted_values, relationship or between."""

    kind: str
    model: str
    column: str
    params: Mapping = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.model}_{self.column}"


def _violation(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return ~c.isin(list(check.params["values"]))
    if check.kind == "between":
        return ~c.between(check.params["min_value"], check.params["max_value"])
    raise ValueError(check.kind)


ROW_LEVEL = ("not_null", "accepted_values", "between")


def _report_rows(counts: DataFrame, checks: Sequence[Check], cols: Sequence[str]) -> DataFrame:
    stacked = F.array(
        *[
            F.struct(
                F.lit(chk.name).alias("check"),
                F.lit(chk.model).alias("model"),
                F.lit(chk.column).alias("column"),
                F.col(c).cast("long").alias("failures"),
            )
            for chk, c in zip(checks, cols)
        ]
    )
    return counts.select(F.explode(stacked).alias("r")).select("r.*")


def _model_pass(df: DataFrame, unique: Check | None, row_checks: Sequence[Check]) -> DataFrame:
    """All checks of one model in one scan.

    Without a uniqueness check: one global aggregate of violation counts.
    With one: the row-level violations are counted inside the aggregation by
    the unique key (partial aggregation before the shuffle), and a second,
    tiny global aggregate adds up duplicates and violations.
    """
    if unique is None:
        counts = df.agg(*[F.count(F.when(_violation(c), F.lit(1))).alias(f"_c{i}") for i, c in enumerate(row_checks)])
        return _report_rows(counts, row_checks, [f"_c{i}" for i in range(len(row_checks))])
    key = F.col(unique.column)
    per_key = df.groupBy(key.alias("_key")).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(F.when(_violation(c), F.lit(1))).alias(f"_v{i}") for i, c in enumerate(row_checks)],
    )
    counts = per_key.agg(
        F.count(F.when(F.col("_key").isNotNull() & (F.col("_n") > 1), F.lit(1))).alias("_u"),
        *[F.coalesce(F.sum(f"_v{i}"), F.lit(0)).alias(f"_c{i}") for i in range(len(row_checks))],
    )
    return _report_rows(counts, [unique, *row_checks], ["_u"] + [f"_c{i}" for i in range(len(row_checks))])


def quality_report(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One row per check: check, model, column, failures, passed (Q6).

    Checks are grouped by model so each model is scanned once: its row-level
    checks (not null, accepted values, range) and its first uniqueness check
    share one aggregation.  Further uniqueness checks and relationship checks
    (a left-anti join each) add their own one-row aggregates.  The parts are
    unioned into one DataFrame.
    """
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for chk in checks:
        by_model.setdefault(chk.model, []).append(chk)
    for model, model_checks in by_model.items():
        row_checks = [c for c in model_checks if c.kind in ROW_LEVEL]
        uniques = [c for c in model_checks if c.kind == "unique"]
        if row_checks or uniques:
            parts.append(_model_pass(models[model], uniques[0] if uniques else None, row_checks))
        for chk in model_checks:
            if chk.kind in ROW_LEVEL or (uniques and chk is uniques[0]):
                continue
            if chk.kind == "unique":
                failing = expect_unique(models[chk.model], chk.column)
            elif chk.kind == "relationship":
                failing = expect_relationship(
                    models[chk.model], chk.column, models[chk.params["to"]], chk.params["field"]
                )
            else:
                raise ValueError(f"unknown check kind {chk.kind!r}")
            parts.append(
                failing.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(chk.name).alias("check"),
                    F.lit(chk.model).alias("model"),
                    F.lit(chk.column).alias("column"),
                    F.col("failures").cast("long").alias("failures"),
                )
            )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.withColumn("passed", F.col("failures") == 0)


# The declared warehouse tests (12 in total).
ACCEPTED_STATUSES = ("placed", "shipped", "completed", "returned", "processing")
REVENUE_RANGE = (0, 1_000_000)

WAREHOUSE_CHECKS: tuple[Check, ...] = (
    Check("unique", "stg_orders", "order_id"),
    Check("not_null", "stg_orders", "order_id"),
    Check("accepted_values", "stg_orders", "status", {"values": ACCEPTED_STATUSES}),
    Check("unique", "dim_customers", "customer_id"),
    Check("not_null", "dim_customers", "customer_id"),
    Check("unique", "dim_products", "product_id"),
    Check("not_null", "dim_products", "product_id"),
    Check("unique", "fct_orders", "order_id"),
    Check("not_null", "fct_orders", "order_id"),
    Check("not_null", "fct_orders", "customer_id"),
    Check("relationship", "fct_orders", "customer_id", {"to": "dim_customers", "field": "customer_id"}),
    Check("between", "fct_orders", "revenue_euro", {"min_value": REVENUE_RANGE[0], "max_value": REVENUE_RANGE[1]}),
)


class QualityGateError(RuntimeError):
    """A build did not pass its checks; ``rows`` is the whole report, a row for each check."""

    def __init__(self, message: str, rows: Sequence = ()) -> None:
        super().__init__(message)
        self.rows = list(rows)


def enforce(report: DataFrame) -> list:
    """Collect the (bounded, one row per check) report and raise on any failure."""
    rows = report.collect()
    failed = [r for r in rows if not r["passed"]]
    if failed:
        raise QualityGateError("failed checks: " + ", ".join(f"{r['check']}={r['failures']}" for r in failed), rows)
    return rows
