"""run_all writes every sink and the governance tables."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from shopsight.operators import quality
from shopsight.published import read_table
from shopsight.runner import KPI_NAMES, run_all
from shopsight.sinks import document_parts
from shopsight.sources.star_schema import tables_from_star
from tests.conftest import SF001


def test_run_all_writes_sinks_and_audit(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="shopsight-run-"), "out")
    run_all(spark, SF001, out_dir=out, check_keys=True)
    qr = spark.read.parquet(os.path.join(out, "analytics", "quality_report"))
    assert qr.filter("check = 'unique' AND violations > 0").count() == 0
    log = spark.read.parquet(os.path.join(out, "analytics", "execution_log"))
    assert log.count() == len(KPI_NAMES) + 6 + 2 + 1 + 1
    assert log.filter(F.col("status") != "SUCCESS").count() == 0
    # the audit table itself passes the governance checks of its DDL
    report = quality.domain(log, "execution_log", "status", ("SUCCESS", "FAILED", "PARTIAL")) \
        .unionByName(quality.unique(log, "execution_log", "log_id"))
    assert sum(r["violations"] for r in report.collect()) == 0
    hist = spark.read.parquet(os.path.join(out, "analytics", "refresh_history"))
    assert hist.count() == 6 and hist.filter("file_size_kb > 0").count() == 6

    t = tables_from_star(spark, SF001)
    # per-entity export: parts that joined in name order are the document
    parts = document_parts(spark, os.path.join(out, "data", "store_performance.json"))
    sp = json.loads("".join(open(p).read() for p in parts))
    assert len(sp["data"]) == t.stores.count()
    revs = [x["revenue"] for x in sp["data"] if x["revenue"] is not None]
    assert revs == sorted(revs, reverse=True) and sp["data"][0]["revenue"] is None
    # bounded export: one document
    d = os.path.join(out, "data", "monthly_trends.json")
    assert os.path.isfile(d)  # served as one file, like the reference's data/<name>.json
    assert not [f for f in os.listdir(os.path.join(out, "data")) if "staging" in f]
    doc = json.loads(open(d).read())
    months = [m["month"] for m in doc["data"]]
    assert len(months) > 12 and months[0] == "Jan 1995"

    kpi = read_table(spark, os.path.join(out, "kpis", "store_performance"))
    assert {"revenue_display", "tier_class"} <= set(kpi.columns)
    mart = read_table(spark, os.path.join(out, "analytics", "metric_mart"))
    assert mart.select("metric").distinct().count() == 7
    reg = spark.read.parquet(os.path.join(out, "analytics", "kpi_metadata"))
    assert reg.count() == 7 and reg.select("kpi_name").distinct().count() == 7


def test_shared_mart_path_equals_standalone_jobs(spark):
    """run_all computes the line KPIs from the persisted product-lines mart;
    the rows must equal the standalone (line-level) jobs."""
    from shopsight.params import FIXTURE_AS_OF, Params
    from shopsight.plans.registry import JOBS

    out = os.path.join(tempfile.mkdtemp(prefix="shopsight-run-"), "out")
    run_all(spark, SF001, out_dir=out)
    t = tables_from_star(spark, SF001)
    p = Params(as_of=FIXTURE_AS_OF)
    for name in ("sales_overview", "monthly_revenue_trend", "revenue_by_region", "region_summary", "order_rollups",
                 "revenue_by_category", "top_products", "product_performance",
                 "category_performance", "customer_lifetime_value", "store_performance",
                 "rfm_analysis", "rfm_segment_summary"):
        want = JOBS[name](t, p)
        got = read_table(spark, os.path.join(out, "kpis", name)).select(*want.columns)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), name


def test_cli_on_business_parquet_tables(spark):
    """``python -m shopsight.runner --tables ...``: business tables in Parquet
    (as a user of the SQL workload would have them) run end to end."""
    from shopsight.runner import main
    from shopsight.sources.business import write_parquet_tables

    root = tempfile.mkdtemp(prefix="shopsight-cli-")
    write_parquet_tables(tables_from_star(spark, SF001), os.path.join(root, "tables"))
    rc = main(["--tables", os.path.join(root, "tables"), "--out", os.path.join(root, "out"),
               "--as-of", "2001-08-02", "--unique-order-id"])
    assert rc == 0
    doc = json.loads(open(os.path.join(root, "out", "data", "sales_overview.json")).read())
    assert doc["data"]["total_orders"] > 0


def _fail(monkeypatch, name):
    import shopsight.runner as runner

    def broken(t, p):
        raise RuntimeError("made to fail")

    monkeypatch.setitem(runner.JOBS, name, broken)


def test_a_failed_run_leaves_its_audit_rows(spark, monkeypatch):
    import pytest

    _fail(monkeypatch, "daily_sales_30d")
    out = os.path.join(tempfile.mkdtemp(prefix="shopsight-run-"), "out")
    with pytest.raises(RuntimeError, match="daily_sales_30d"):
        run_all(spark, SF001, out_dir=out, check_keys=False)
    log = spark.read.parquet(os.path.join(out, "analytics", "execution_log"))
    assert [r.kpi_name for r in log.filter("status = 'FAILED'").collect()] == ["daily_sales_30d"]
    assert log.filter("kpi_name = 'run_all' AND status = 'PARTIAL'").count() == 1


def test_stamps_are_utc_in_any_zone(spark):
    """The host's zone must not shift generated_at or refreshed_at."""
    import datetime as dt
    import time

    from shopsight.sinks import refresh_files, refresh_rows, utc_now

    old = os.environ.get("TZ")
    os.environ["TZ"] = "Asia/Kolkata"
    time.tzset()
    try:
        now = utc_now()
        path = os.path.join(tempfile.mkdtemp(prefix="shopsight-tz-"), "x.json")
        open(path, "w").write("{}")
        row = refresh_rows(refresh_files(spark, path, "x.json", "run"), now).first()
        stamp = spark.range(1).select(F.lit(now).cast("string").alias("s")).first().s
    finally:
        os.environ.pop("TZ") if old is None else os.environ.__setitem__("TZ", old)
        time.tzset()
    want = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert abs((row.refreshed_at - want).total_seconds()) < 300
    assert stamp[:13] == now.strftime("%Y-%m-%d %H")


def test_scopes_do_not_disturb_each_other(spark):
    from shopsight.session import Scope, materialize

    with Scope(spark) as outer:
        kept = materialize(spark.range(10))
        with Scope(spark) as inner:
            materialize(spark.range(5))
        assert kept.count() == 10
        assert not os.path.exists(inner.root.removeprefix("file:"))
    assert not os.path.exists(outer.root.removeprefix("file:"))
