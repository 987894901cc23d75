"""Type-2 history with the "check" strategy.

``snapshot(incoming, key, batch_ts, previous)`` returns the complete new
history as a DataFrame; write it to a new path (Spark cannot overwrite the
path it reads).  Semantics:

* first load: every incoming row is opened at ``batch_ts``;
* key unchanged (null-safe comparison of all checked columns): row kept;
* key changed: the open row is closed at ``batch_ts`` and a new one opened;
* key new: a row is opened;
* key absent from the delivery: its open row stays open (no hard deletes);
* closed rows pass through untouched.

Every delivery, the first one included, must have one row per key and no null
key: the job fails otherwise.

Plan shape: closed history is a filtered scan that never enters a shuffle.
Open rows (at most one per key) and the delivery (validated by an aggregate
that fails the job on a duplicate or null key) meet in one full outer
equi-join, so no key can be hot on either side. Marker columns tell which
sides a joined row has, so that open rows stay whatever their key reads.  Each joined row emits its
one or two output rows through ``explode``; nothing is computed twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _ts_literal(batch_ts: dt.datetime | str):
    if isinstance(batch_ts, str):
        batch_ts = dt.datetime.fromisoformat(batch_ts)
    return F.lit(batch_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def scd_id(key: str, ts_col) -> "F.Column":
    """Per-version hash: md5 of ``key|timestamp``."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), ts_col.cast("string")))


def unique_per_key(incoming: DataFrame, key: str) -> DataFrame:
    """One row per key; a duplicate or null key fails the job when the plan runs."""
    attrs = [c for c in incoming.columns if c != key]
    agg = incoming.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.first(F.struct(*attrs)).alias("_row"),
    )
    guard = (
        F.when(F.col(key).isNull(), F.raise_error(F.lit(f"null snapshot key: {key}")))
        .when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate snapshot key: "), F.col(key).cast("string"))))
        .otherwise(F.lit(True))
    )
    return agg.where(guard).select(key, *[F.col(f"_row.{c}").alias(c) for c in attrs])


def snapshot(
    incoming: DataFrame,
    key: str,
    batch_ts: dt.datetime | str,
    previous: DataFrame | None = None,
    check_cols: Sequence[str] | str = "all",
) -> DataFrame:
    ts = _ts_literal(batch_ts)
    attrs = [c for c in incoming.columns if c != key]
    checked = attrs if check_cols == "all" else list(check_cols)
    missing = [c for c in checked if c not in attrs]
    if missing:
        raise ValueError(f"check columns not in the delivery: {missing}")

    if previous is None:
        return unique_per_key(incoming, key).select(
            key,
            *attrs,
            scd_id(key, ts).alias("scd_id"),
            ts.alias("updated_at"),
            ts.alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        )

    prev_attrs = [c for c in previous.columns if c != key and c not in SCD_COLUMNS]
    if sorted(prev_attrs) != sorted(attrs):
        raise ValueError(f"schema drift between history {sorted(prev_attrs)} and delivery {sorted(attrs)}")

    out_cols = [key, *attrs, *SCD_COLUMNS]
    closed = previous.where(F.col("valid_to").isNotNull()).select(*out_cols)
    open_rows = previous.where(F.col("valid_to").isNull()).select(*out_cols)
    current = merge_open_rows(open_rows, incoming, key, batch_ts, checked)
    return closed.unionByName(current)


def merge_open_rows(
    open_rows: DataFrame,
    incoming: DataFrame,
    key: str,
    batch_ts: dt.datetime | str,
    check_cols: Sequence[str] | str = "all",
) -> DataFrame:
    """Merge the open versions with a delivery.

    Returns the rows that replace ``open_rows``: unchanged and absent keys
    kept open, changed keys closed at ``batch_ts`` plus their new open
    version, new keys opened.  Closed history is not an input: it never
    changes, so incremental writers only append the rows closed here.
    """
    ts = _ts_literal(batch_ts)
    attrs = [c for c in incoming.columns if c != key]
    checked = attrs if check_cols == "all" else list(check_cols)
    out_cols = [key, *attrs, *SCD_COLUMNS]
    delivery = unique_per_key(incoming, key)
    p = open_rows.select(*[F.col(c).alias(f"p_{c}") for c in out_cols], F.lit(True).alias("_in_history"))
    i = delivery.select(*[F.col(c).alias(f"i_{c}") for c in [key, *attrs]], F.lit(True).alias("_in_delivery"))
    j = p.join(i, F.col(f"p_{key}") == F.col(f"i_{key}"), "full_outer")

    has_p = F.col("_in_history").isNotNull()
    has_i = F.col("_in_delivery").isNotNull()
    same = F.struct(*[F.col(f"p_{c}") for c in checked]).eqNullSafe(F.struct(*[F.col(f"i_{c}") for c in checked]))
    changed = has_p & has_i & ~same

    old_version = F.struct(
        *[F.col(f"p_{c}").alias(c) for c in [key, *attrs, "scd_id", "updated_at", "valid_from"]],
        F.when(changed, ts).otherwise(F.col("p_valid_to")).alias("valid_to"),
    )
    new_version = F.struct(
        F.col(f"i_{key}").alias(key),
        *[F.col(f"i_{c}").cast(open_rows.schema[c].dataType).alias(c) for c in attrs],
        scd_id(f"i_{key}", ts).alias("scd_id"),
        ts.alias("updated_at"),
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    versions = F.array(
        F.when(has_p, old_version),
        F.when(has_i & (~has_p | changed), new_version),
    )
    return j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select(
        *[F.col(f"v.{c}").alias(c) for c in out_cols]
    )
