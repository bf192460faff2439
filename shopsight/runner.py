"""Run every KPI, export and catalog job once, sharing persisted marts.

``run_all`` is the batch entry point a scheduler calls. With ``out_dir`` it
writes:
  kpis/<name>/           Parquet KPI tables (store and product tables with display columns)
  data/<name>.json       one JSON document per dashboard export: a single file, or for
                         store_performance and category_sales a dataset whose parts,
                         joined in name order, are the document
  display/<name>/        the two exports that the page formats, with display columns
  analytics/metric_mart/ long-format metric mart, partitioned by metric
  analytics/kpi_metadata/, execution_log/, refresh_history/, refresh_files/  governance tables
KPI and display tables, the mart and the documents in parts are versioned
datasets: ``published.read_table`` and ``sinks.document_parts`` read the current
version. A run that is replayed under its ``run_id`` adds no audit rows.
Without ``out_dir`` every job still runs in full into the ``noop`` sink.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import SparkSession

from shopsight.functions.display import with_display
from shopsight.operators import quality
from shopsight.params import FIXTURE_AS_OF, Params
from shopsight.plans import catalog, governance
from shopsight.plans.exports import EXPORTS, SINGLE_OBJECT
from shopsight.plans.marts import Marts, calling
from shopsight.plans.registry import JOBS, KPIS
from shopsight.session import Scope
from shopsight.sinks import AuditLog, utc_now, write_document, write_table
from shopsight.sources.star_schema import tables_from_star
from shopsight.sources.tables import Tables

KPI_NAMES = [*KPIS, "order_rollups"]
DISPLAY_EXPORTS = ("store_performance", "top_products")


def run_all(spark: SparkSession, sf_dir: str | None = None, out_dir: str | None = None,
            params: Params = Params(as_of=FIXTURE_AS_OF), tables: Tables | None = None,
            fail_fast: bool = True, check_keys: bool = True, run_id: str | None = None) -> AuditLog:
    """Run everything. ``check_keys`` first verifies the keys the
    pre-aggregated plans rely on (unique dimension and declared keys) and
    stops before any output is written if one is violated; the full report
    (incl. NULL keys and orphans) is written to ``analytics/quality_report``. NULL
    keys and values outside their domain are counted by the scans that the marts
    make anyway (``marts.WATCHED``, ``analytics/scan_report``): a KPI table that is
    made of such rows is not published, and the run ends there."""
    t = tables if tables is not None else tables_from_star(spark, sf_dir)
    if check_keys:
        report = quality.key_report(t).unionByName(
            quality.max_length(catalog.registry(spark), "kpi_metadata", governance.MAX_LENGTHS["kpi_metadata"]))
        if out_dir:
            report.write.mode("overwrite").parquet(os.path.join(out_dir, "analytics",
                                                                "quality_report"))
            report = spark.read.parquet(os.path.join(out_dir, "analytics", "quality_report"))
        quality.assert_clean(report, checks=("unique", "length"))
        quality.assert_keys(report, t)
    watch = quality.Watch() if check_keys else None
    marts = Marts(t, params, persist=True, watch=watch)
    audit = AuditLog(spark, run_id)
    generated_at = utc_now()

    def path(*parts):
        return os.path.join(out_dir, *parts) if out_dir else None

    def run(name: str, job) -> bool:
        status, err = audit.timed(name, job)
        if status != "SUCCESS" and fail_fast:
            raise RuntimeError(f"{name} failed: {err}")
        return status == "SUCCESS"

    try:
        with Scope(spark):
            for name in KPI_NAMES:
                # timed from definition on: ranking jobs materialize their input while defined
                def kpi(name=name):
                    df = with_display(name, calling(JOBS[name], t, params, marts))
                    return write_table(df, path("kpis", name), name, verify=watch and watch.assert_clean)

                run(name, kpi)
            for name, (fn, bounded) in EXPORTS.items():
                target = path("data", f"{name}.json")

                def export(fn=fn, target=target, single=name in SINGLE_OBJECT, bounded=bounded):
                    payload = calling(fn, t, params, marts)
                    return write_document(payload, single, target, generated_at, bounded), "SUCCESS"

                if run(f"export_{name}", export) and target:
                    audit.refreshed(target, f"{name}.json")
            for name in DISPLAY_EXPORTS:
                def shown(name=name):
                    df = with_display(f"export_{name}", calling(EXPORTS[name][0], t, params, marts))
                    return write_table(df, path("display", name), name)

                run(f"display_{name}", shown)
            run("metric_mart", lambda: write_table(
                catalog.metric_mart(t), path("analytics", "metric_mart"), "metric_mart", ("metric",)))
            if out_dir:
                catalog.registry(spark).write.mode("overwrite").parquet(path("analytics", "kpi_metadata"))
            if watch and out_dir:
                write_table(spark.createDataFrame(watch.report(), "check STRING, table STRING, columns STRING, violations BIGINT"),
                            path("analytics", "scan_report"), "scan_report")
    finally:
        marts.release()
        audit.close()
        if out_dir:  # a run that failed is on record, too
            audit.append(path("analytics"), generated_at)
    return audit


def main(argv: list[str] | None = None) -> int:
    """Command line: ``python -m shopsight.runner --out DIR (--star DIR |
    --tables DIR | --database NAME) [--as-of YYYY-MM-DD] [--no-check-keys]
    [--input-bytes N --total-cores N]``."""
    import argparse

    from shopsight.session import build_session, cluster_conf
    from shopsight.sources.business import read_catalog_tables, read_parquet_tables

    ap = argparse.ArgumentParser(prog="shopsight.runner")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--star", help="folder of the test star schema (mapped per FIXTURES.md)")
    src.add_argument("--tables", help="folder with one Parquet dataset per business table")
    src.add_argument("--database", help="catalog database holding the business tables")
    ap.add_argument("--out", required=True, help="output folder (KPI tables, documents, logs)")
    ap.add_argument("--as-of", help="date used for CURRENT_DATE (default: today)")
    ap.add_argument("--unique-order-id", action="store_true",
                    help="declare orders.order_id unique (counts instead of distinct counts)")
    ap.add_argument("--no-check-keys", action="store_true", help="don't verify keys before running")
    ap.add_argument("--input-bytes", type=int, help="input size; with --total-cores, sizes the partitions")
    ap.add_argument("--total-cores", type=int, help="cores of the cluster")
    ap.add_argument("--master", help="Spark master (default: from the environment)")
    args = ap.parse_args(argv)

    sized = bool(args.input_bytes and args.total_cores)
    spark = build_session(args.master, extra=cluster_conf(args.input_bytes, args.total_cores) if sized else None)
    keys = {"orders": "order_id"} if args.unique_order_id else {}
    if args.star:
        tables = tables_from_star(spark, args.star)
    elif args.tables:
        tables = read_parquet_tables(spark, args.tables, keys)
    else:
        tables = read_catalog_tables(spark, args.database, keys)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else None
    audit = run_all(spark, tables=tables, out_dir=args.out, params=Params(as_of=as_of),
                    check_keys=not args.no_check_keys)
    failed = [r for r in audit.rows if r[5] != "SUCCESS"]
    print(f"{len(audit.rows)} jobs, {len(failed)} failed; output in {args.out}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
