"""Row checks ride on the marts' own scans and stop a run before it publishes."""

import json
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from shopsight.operators.quality import Key, Watch, domain_check, keys_report, null_check
from shopsight.params import FIXTURE_AS_OF, Params
from shopsight.plans import marts
from shopsight.plans.marts import Marts
from shopsight.published import read_table
from shopsight.runner import run_all
from shopsight.sources.star_schema import tables_from_star
from shopsight.sources.tables import Tables
from tests.conftest import SF001

P = Params(as_of=FIXTURE_AS_OF)


@pytest.fixture(scope="module")
def t(spark):
    return tables_from_star(spark, SF001)


def _with(t, **frames):
    return t.replaced(**frames)


def test_counts_come_with_the_scan(spark, t):
    odd = t.orders.withColumn("order_status", F.when(F.col("order_id") % 5 == 0, "Lost").otherwise(F.col("order_status"))).withColumn(
        "cust_id", F.when(F.col("order_id") % 7 != 0, F.col("cust_id")))
    watch = Watch()
    shared = Marts(_with(t, orders=odd), P, persist=True, watch=watch)
    try:
        df = marts.order_rollup(shared.t, P, [], shared)
        assert watch.report() == []  # nothing has run yet, and nothing waits
        df.collect()
        got = {(c, k): n for c, tbl, k, n in watch.report()}
        want = odd.agg(F.count_if(F.col("cust_id").isNull()), F.count_if(F.col("order_status") == "Lost")).first()
        assert got["not_null", "cust_id"] == want[0] and got["domain", "order_status"] == want[1] > 0
        assert got["not_null", "order_id"] == 0
        with pytest.raises(ValueError, match="orders.order_status"):
            watch.assert_clean()
    finally:
        shared.release()


def _jobs(spark, job):
    """Jobs that Spark starts for ``job``, by its own count."""
    tracker = spark.sparkContext.statusTracker()
    group = f"watched-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        job()
        return len(tracker.getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_job_for_the_checks(spark, t):
    def overview(watch):
        shared = Marts(t, P, persist=True, watch=watch)
        try:
            return lambda: (marts.order_rollup(t, P, [], shared).collect(), watch and watch.assert_clean())
        finally:
            shared.release()

    assert _jobs(spark, overview(Watch())) == _jobs(spark, overview(None))


@pytest.mark.parametrize("table", ["order_items", "orders"])
def test_a_run_stops_before_it_publishes(spark, t, table):
    key = {"order_items": "prod_id", "orders": "order_status"}[table]
    odd = t.get(table).withColumn(key, F.when(F.col("order_id") % 5 != 0, F.col(key)))
    out = os.path.join(tempfile.mkdtemp(prefix="shopsight-watch-"), "out")
    run_all(spark, out_dir=out, tables=t)
    before = read_table(spark, f"{out}/kpis/sales_overview").collect()
    assert read_table(spark, f"{out}/analytics/scan_report").where("columns = 'discount'").first().violations > 0
    with pytest.raises(RuntimeError, match="data quality violations"):
        run_all(spark, out_dir=out, tables=_with(t, **{table: odd}))
    failed = "sales_overview" if table == "orders" else "revenue_by_category"
    log = spark.read.parquet(f"{out}/analytics/execution_log")
    assert [r.kpi_name for r in log.where("status = 'FAILED' and kpi_name != 'run_all'").collect()] == [failed]
    assert read_table(spark, f"{out}/kpis/sales_overview").collect() == before
    assert json.load(open(f"{out}/data/sales_overview.json"))["data"]["total_orders"] == before[0].total_orders


def test_keys_in_one_pass(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,), (9,)], "k long")
    kids = spark.createDataFrame([(1, 5), (1, 5), (3, 5), (3, 6), (None, None), (2, 7)], "k long, j long")
    others = spark.createDataFrame([(5,), (6,)], "j long")

    class Some(Tables):
        def __init__(self, **frames):
            self._frames, self._factories, self.unique_keys = frames, {}, {}

    got = {tuple(r) for r in keys_report(Some(p=parents, c=kids, o=others), [Key("k", "p", ("c",)), Key("j", "o", ("c",))], {"p", "o"}).collect()}
    assert got == {("unique", "p", "k", 2), ("not_null", "c", "k", 1), ("orphans", "c", "k", 2), ("not_null", "p", "k", 2),
                   ("unique", "o", "j", 0), ("not_null", "c", "j", 1), ("orphans", "c", "j", 1), ("not_null", "o", "j", 0)}


def test_key_report_scans_each_table_once(spark, t):
    from shopsight.operators.quality import key_report

    plan = key_report(t)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert sum("lineitem" in x for x in scans) == 1 and sum("o_custkey" in x for x in scans) == 1


def test_checks_of_odd_columns(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, y string")
    watch = Watch()
    watch.on(df, "t", [null_check("x"), domain_check("y", ("a",), strict=False)]).count()
    seen = watch.on(df, "t", [])
    assert seen is df and sorted(watch.report()) == [("domain", "t", "y", 2), ("not_null", "t", "x", 1)]
