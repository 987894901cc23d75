from __future__ import annotations

import datetime as dt
import glob
import os
import tempfile
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from martlake.operators import metrics, models, quality, scd2
from martlake.plans import catalog
from martlake.plans.warehouse import (
    build_warehouse,
    materialize_marts,
    published_marts,
    read_marts,
    resolve_view_params,
    write_order_marts,
)
from martlake.session import ensure_checkpoint_dir
from martlake.sources import history, tables, testdata
from martlake.sources.versions import Versions
from tests.conftest import SF_SMALL, d


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="martlake-test-")


def _write_raw(spark, base, mutate=None):
    raw = testdata.raw_tables(spark, SF_SMALL)
    if mutate:
        raw = mutate(raw)
    for name, df in raw.items():
        tables.write_table(df, os.path.join(base, name))


def test_register_raw_skips_missing(spark, scratch):
    _write_raw(spark, scratch)
    found = tables.register_raw(spark, scratch, names=["raw_orders", "raw_missing"])
    assert list(found) == ["raw_orders"]
    assert spark.table("raw_orders").schema == tables.RAW_SCHEMAS["raw_orders"]


def test_read_table_conforms_schema(spark, scratch):
    _write_raw(spark, scratch)
    df = tables.read_table(spark, os.path.join(scratch, "raw_products"), schema=tables.RAW_SCHEMAS["raw_products"])
    assert df.columns == [f.name for f in tables.RAW_SCHEMAS["raw_products"].fields]


def test_seed_csv_scan(spark, scratch):
    path = os.path.join(scratch, "date_dimension.csv")
    with open(path, "w") as fh:
        fh.write("date_id,date_day,year,month,month_name,day,quarter,day_of_week\n")
        fh.write("20240101,2024-01-01,2024,1,January,1,1,Monday\n")
    row = tables.read_seed_csv(spark, path).first()
    assert row.date_day == d("2024-01-01") and row.date_id == 20240101


def test_export_csv_and_export_all(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    empty = df.where("x > 5")
    written = tables.export_all({"one": df, "none": empty, "missing": None, "unknown": None}, scratch, {"missing": df.schema})
    assert written == ["one", "none", "missing"]
    back = spark.read.csv(os.path.join(scratch, "one"), header=True)
    assert back.columns == ["x", "y"] and back.count() == 1
    for name in ("none", "missing"):  # a header and no rows
        back = spark.read.csv(os.path.join(scratch, name), header=True)
        assert back.columns == ["x", "y"] and back.count() == 0


def test_marts_follow_their_input(spark, scratch):
    for name in testdata.TABLES:
        spark.read.parquet(f"{SF_SMALL}/{name}.parquet").write.parquet(os.path.join(scratch, f"{name}.parquet"))
    first = catalog.marts(spark, scratch)
    assert catalog.marts(spark, scratch).path == first.path
    n = first.fct_orders.count()
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    orders.limit(1).withColumn("o_orderkey", F.lit(10**9).cast(orders.schema["o_orderkey"].dataType)).write.mode("append").parquet(os.path.join(scratch, "orders.parquet"))
    catalog.warehouse.cache_clear()
    second = catalog.marts(spark, scratch)
    assert second.path != first.path and second.fct_orders.count() == n + 1


def test_params_of_an_empty_fact_are_open(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    win = resolve_view_params(wh.fct_orders.limit(0), wh.dim_customers)
    assert win.start is None and win.end is None and len(win.cities) == 5
    assert metrics.kpi(wh.fct_orders, wh.dim_customers, win).first().orders > 0


def test_checkpoint_folder_must_be_set_off_local():
    from unittest import mock

    from martlake.session import ensure_checkpoint_dir

    cluster = mock.MagicMock()
    cluster.conf.get.return_value = None
    cluster.sparkContext.getConf().get.return_value = None
    cluster.sparkContext.getCheckpointDir.return_value = None
    cluster.sparkContext.master = "yarn"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


def test_build_warehouse_end_to_end(spark, scratch):
    raw_dir, out_dir = os.path.join(scratch, "raw"), os.path.join(scratch, "out")
    _write_raw(spark, raw_dir)
    rows = build_warehouse(spark, raw_dir, out_dir, "2024-01-01 00:00:00")
    assert len(rows) == 12 and all(r["passed"] for r in rows)
    items = spark.read.parquet(os.path.join(raw_dir, "raw_order_items"))
    built = read_marts(spark, os.path.join(out_dir, "marts"), items)
    assert built.fct_orders.count() == spark.read.parquet(os.path.join(raw_dir, "raw_orders")).count()
    # dashboard queries over the scheduled build equal those over the lazy warehouse
    lazy = catalog.warehouse(spark, SF_SMALL)
    got = metrics.monthly_trend(built.fct_orders, built.dim_customers, catalog.W).collect()
    assert got == metrics.monthly_trend(lazy.fct_orders, lazy.dim_customers, catalog.W).collect()
    for name in ("fct_orders", "dim_customers", "dim_products"):
        columns = getattr(lazy, name).columns
        one, other = (getattr(x, name).select(columns) for x in (built, lazy))
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def _second_load(raw):
    return {**raw, "raw_customers": testdata.second_customer_load(raw["raw_customers"])}


def _folders(history_dir, batch):
    return {os.path.basename(p) for p in glob.glob(os.path.join(history_dir, f"batch={batch}", "attempt=*", "state=*"))}


def test_second_build_reads_and_writes_no_former_closed_rows(spark, scratch):
    out_dir = os.path.join(scratch, "out")
    history_dir = os.path.join(out_dir, "history")
    for i, mutate in enumerate((None, _second_load, None)):  # the third delivery is the first one again
        raw_dir = os.path.join(scratch, f"raw{i}")
        _write_raw(spark, raw_dir, mutate)
        build_warehouse(spark, raw_dir, out_dir, dt.datetime(2024, 1 + i, 1))
    first = testdata.raw_customers(spark, SF_SMALL)
    want = scd2.snapshot(first, "customer_id", dt.datetime(2024, 1, 1))
    want = scd2.snapshot(testdata.second_customer_load(first), "customer_id", dt.datetime(2024, 2, 1), want)
    closed_by_second = want.where("valid_to is not null").count()
    want = scd2.snapshot(first, "customer_id", dt.datetime(2024, 3, 1), want)
    got = history.read_history(spark, history_dir).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert [_folders(history_dir, b) for b in range(3)] == [{"state=open"}, {"state=open", "state=closed"}, {"state=open", "state=closed"}]
    written = spark.read.parquet(history_dir).where("state = 'closed'").groupBy("batch").count().collect()
    assert {r.batch: r["count"] for r in written} == {1: closed_by_second, 2: want.where("valid_to is not null").count() - closed_by_second}
    opened = history.read_open(spark, history_dir)
    files = [r[0] for r in opened.select(F.input_file_name()).distinct().collect()]
    assert files and all("batch=2" in f and "state=open" in f for f in files)
    # the folders are chosen before the scan: files of other ones can't be read, and are not
    for path in glob.glob(os.path.join(history_dir, "batch=*", "attempt=*", "state=closed", "*.parquet")):
        os.rename(path, f"{path}.away")
        open(path, "w").close()
    assert history.read_open(spark, history_dir).count() == want.where("valid_to is null").count()
    for path in glob.glob(os.path.join(history_dir, "batch=*", "attempt=*", "state=closed", "*.away")):
        os.rename(path, path.removesuffix(".away"))
    dim = read_marts(spark, os.path.join(out_dir, "marts"), spark.range(0)).dim_customers
    assert dim.where(~F.col("is_current")).count() == want.where("valid_to is not null").count()
    # open sets of former batches can go, and nothing else is lost
    assert history.expire_open(spark, history_dir, keep=1) == [0, 1]
    again = history.read_history(spark, history_dir).select(want.columns)
    assert again.exceptAll(want).isEmpty() and want.exceptAll(again).isEmpty()


def test_failed_gate_keeps_former_marts_and_history(spark, scratch):
    raw_dir, bad_dir, out_dir = (os.path.join(scratch, x) for x in ("raw", "bad", "out"))
    _write_raw(spark, raw_dir)

    def bad(raw):
        orders = raw["raw_orders"]
        return {**_second_load(raw), "raw_orders": orders.unionByName(orders.limit(3))}  # duplicate order ids

    _write_raw(spark, bad_dir, bad)
    marts_dir, history_dir = os.path.join(out_dir, "marts"), os.path.join(out_dir, "history")
    with pytest.raises(quality.QualityGateError, match="unique_stg_orders_order_id"):
        build_warehouse(spark, bad_dir, out_dir, "2024-01-01 00:00:00")
    assert read_marts(spark, marts_dir, spark.range(0)) is None and history.read_history(spark, history_dir) is None
    build_warehouse(spark, raw_dir, out_dir, "2024-01-01 00:00:00")
    before = read_marts(spark, marts_dir, spark.range(0))
    rows = {name: getattr(before, name).count() for name in ("fct_orders", "dim_customers", "order_products")}
    with pytest.raises(quality.QualityGateError):
        build_warehouse(spark, bad_dir, out_dir, "2024-02-01 00:00:00")
    after = read_marts(spark, marts_dir, spark.range(0))
    assert after.path == before.path
    assert {name: getattr(after, name).count() for name in rows} == rows
    assert history.latest_batch(spark, history_dir) == 0 and history.read_history(spark, history_dir).where("valid_to is not null").isEmpty()
    # what the failed builds left can be removed
    failed = Versions(spark, marts_dir).expire(unpublished_before=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    assert len(failed) == 2 and read_marts(spark, marts_dir, spark.range(0)).fct_orders.count() == rows["fct_orders"]


def test_report_of_a_build_that_fails_a_check(spark, scratch):
    for name in testdata.TABLES:
        table = testdata.read_driver_table(spark, SF_SMALL, name)
        if name == "lineitem":  # one order above the range of revenues
            one = table.orderBy("l_orderkey").limit(1).withColumn("l_extendedprice", F.lit(2_000_000.0))
            table = table.unionByName(one)
        table.write.parquet(os.path.join(scratch, f"{name}.parquet"))
    rows = catalog.QUERIES["warehouse_build_report"](spark, scratch).collect()
    assert len(rows) == len(quality.WAREHOUSE_CHECKS)
    assert {r["check"]: r["failures"] for r in rows if not r["passed"]} == {"between_fct_orders_revenue_euro": 1}
    out = os.path.join(ensure_checkpoint_dir(spark), "martlake-build", catalog._listing(spark, scratch))
    assert read_marts(spark, os.path.join(out, "marts"), spark.range(0)) is None
    assert history.latest_batch(spark, os.path.join(out, "history")) is None


def test_half_written_marts_are_written_again(spark, scratch):
    wh = catalog.warehouse(spark, SF_SMALL)
    versions = Versions(spark, scratch)
    half = versions.new()  # the driver was lost in the commit of the last mart
    materialize_marts(wh, versions.folder(half))
    parts = glob.glob(os.path.join(versions.path(half, "order_products"), "*.parquet"))
    for part in parts[: (len(parts) + 1) // 2]:
        os.remove(part)
    assert read_marts(spark, scratch, wh.raw_order_items) is None
    found = published_marts(wh, scratch)
    assert half not in found.path
    assert found.order_products.agg(F.sum("items")).first()[0] == wh.raw_order_items.count()
    assert published_marts(wh, scratch).path == found.path


def test_builds_that_run_together_leave_one_version_in_use(spark, scratch):
    wh = catalog.warehouse(spark, SF_SMALL)
    versions = Versions(spark, scratch)
    names = [versions.new() for _ in range(2)]
    for name in names:
        versions.publish(name, [])  # both found nothing and wrote
    assert versions.current()["version"] == names[1]
    with ThreadPoolExecutor(2) as pool:
        found = list(pool.map(lambda _: published_marts(wh, os.path.join(scratch, "both")), range(2)))
    both = Versions(spark, os.path.join(scratch, "both"))
    assert {both.folder(both.current()["version"])} <= {f.path for f in found}
    assert len({read_marts(spark, both.root, wh.raw_order_items).path for _ in range(3)}) == 1
    assert all(f.fct_orders.count() == wh.raw_orders.count() for f in found)


def test_versions_expire(spark, scratch):
    versions = Versions(spark, scratch)
    assert versions.current() is None and versions.expire() == []
    names = []
    for i in range(4):
        names.append(versions.new())
        spark.range(i).write.parquet(versions.path(names[-1], "t"))
        versions.publish(names[-1], ["t"], {"i": str(i)})
    assert versions.read(versions.current(), "t").count() == 3 and versions.current()["about"] == {"i": "3"}
    with pytest.raises(KeyError):
        versions.read(versions.current(), "u")
    assert sorted(versions.expire(keep=2)) == names[:2]
    assert sorted(os.listdir(os.path.join(scratch, "versions"))) == names[2:]
    assert versions.current()["version"] == names[3] and versions.published().count() == 2


def test_one_attempt_of_a_batch_counts(spark, scratch):
    first = testdata.raw_customers(spark, SF_SMALL)
    attempts = [history.stage(first, scratch, 0, dt.datetime(2024, 1, 1)) for _ in range(2)]
    history.commit(spark, scratch, 0, attempts[1], dt.datetime(2024, 1, 1))
    with pytest.raises(RuntimeError, match="another run"):
        history.commit(spark, scratch, 0, attempts[0], dt.datetime(2024, 1, 1))
    assert history.committed(spark, scratch) == [(0, attempts[1])]
    assert history.read_history(spark, scratch).count() == first.count()


def test_items_are_scanned_once_and_no_range_is_sampled(spark, scratch, monkeypatch):
    plans, real = [], DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return real(self, path, *args, **kwargs)

    raw_dir = os.path.join(scratch, "raw")
    _write_raw(spark, raw_dir)
    items = tables.read_table(spark, os.path.join(raw_dir, "raw_order_items"))
    orders = tables.read_table(spark, os.path.join(raw_dir, "raw_orders"))
    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    write_order_marts(models.stg_orders(orders), items, os.path.join(scratch, "marts"))
    assert len(plans) == 2 and all("rangepartitioning" not in p and "REBALANCE" in p for p in plans)
    assert all("InMemoryTableScan" in p or "InMemoryRelation" in p for p in plans)


def test_resolve_view_params(spark):
    wh = catalog.warehouse(spark, SF_SMALL)
    win = resolve_view_params(wh.fct_orders, wh.dim_customers)
    assert win.start == d("1995-01-01") and len(win.cities) == 5
    win2 = resolve_view_params(
        wh.fct_orders, wh.dim_customers, {"start": "1996-01-01", "end": "1996-12-31", "cities": ["NATION_3", "X"]}
    )
    assert (win2.start, win2.end, win2.cities) == (d("1996-01-01"), d("1996-12-31"), ("NATION_3",))
