"""What the sinks leave behind, read back: KPI tables and the audit logs.

Each job writes into a folder of its own under the shared checkpoint folder,
reads it back as a later reader would, and removes it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopsight import published, sinks
from shopsight.operators import quality
from shopsight.params import Params
from shopsight.plans import catalog, metrics
from shopsight.plans.exports import EXPORTS, SINGLE_OBJECT
from shopsight.plans.marts import Marts, calling
from shopsight.session import checkpoint_dir, materialize
from shopsight.sources.tables import Tables

Job = Callable[..., DataFrame]

#: Fixed value: the stamp of the documents that are written here.
STAMP = dt.datetime(2001, 8, 2, tzinfo=dt.timezone.utc)

#: The longest values of the governance tables' bounded columns.
MAX_LENGTHS = {
    "kpi_metadata": {"kpi_name": 100, "kpi_category": 50, "owner": 100},
    "execution_log": {"kpi_name": 100, "status": 20},
    "refresh_history": {"data_file": 100},
}


@contextmanager
def _folder(spark: SparkSession) -> Iterator[str]:
    root = f"{checkpoint_dir(spark).rstrip('/')}/shopsight-written-{uuid.uuid4().hex}"
    try:
        yield root
    finally:
        published.Folder(spark, root).delete("")


def logged_run(t: Tables, p: Params, jobs: dict[str, Job]) -> DataFrame:
    """What the execution log records of running ``jobs`` in full."""
    audit = sinks.AuditLog(t.orders.sparkSession)
    for name, job in jobs.items():
        audit.timed(name, lambda name=name, job=job: sinks.write_table(job(t, p), None, name))
    audit.close()
    return audit.execution_log()


def published_kpis(t: Tables, p: Params, jobs: dict[str, Job]) -> DataFrame:
    """The KPI tables of a run as their readers find them: (kpi_name, version,
    record_count), counted in the files of the current version."""
    spark = t.orders.sparkSession
    marts = Marts(t, p, persist=True)
    with _folder(spark) as root:
        try:
            for name, job in jobs.items():
                sinks.write_table(calling(job, t, p, marts), f"{root}/{name}", name)
        finally:
            marts.release()
        found = None
        for name in jobs:
            rows = published.read_table(spark, f"{root}/{name}").agg(F.count(F.lit(1)).alias("record_count")).select(
                F.lit(name).alias("kpi_name"), F.lit(published.current(spark, f"{root}/{name}")["version"]).alias("version"),
                "record_count")
            found = rows if found is None else found.unionByName(rows)
        return materialize(found)


def read_back(t: Tables, p: Params, name: str, job: Job) -> DataFrame:
    """A KPI table that was published twice, from its current version."""
    spark = t.orders.sparkSession
    with _folder(spark) as root:
        sinks.write_table(job(t, p).limit(0), f"{root}/{name}", name)
        sinks.write_table(job(t, p), f"{root}/{name}", name)
        return materialize(published.read_table(spark, f"{root}/{name}"))


def refresh_audit(t: Tables, p: Params) -> DataFrame:
    """The refresh log after all documents were written and the run's audit rows
    appended twice: (data_file, refreshed_at, record_count, file_size_kb)."""
    spark = t.orders.sparkSession
    with _folder(spark) as root:
        audit = sinks.AuditLog(spark, run_id="refresh")
        for name, (fn, bounded) in EXPORTS.items():
            path = f"{root}/data/{name}.json"
            sinks.write_document(fn(t, p), name in SINGLE_OBJECT, path, STAMP, bounded)
            audit.refreshed(path, f"{name}.json")
        audit.close()
        for _ in range(2):
            audit.append(f"{root}/analytics", STAMP)
        history = spark.read.parquet(f"{root}/analytics/refresh_history")
        return materialize(history.select("data_file", "refreshed_at", "record_count", "file_size_kb"))


def length_report(t: Tables, p: Params, jobs: dict[str, Job]) -> DataFrame:
    """Values that are longer than their bounded column: names and categories
    wherever the metric rows carry them, and the rows of a run's log."""
    named = catalog.metric_catalog(t).select(F.col("metric").alias("kpi_name"), "kpi_category")
    limits = {k: v for k, v in MAX_LENGTHS["kpi_metadata"].items() if k != "owner"}
    owners = catalog.registry(t.orders.sparkSession)
    out = quality.max_length(named, "kpi_metadata", limits)
    out = out.unionByName(quality.max_length(owners, "kpi_metadata", {"owner": MAX_LENGTHS["kpi_metadata"]["owner"]}))
    return out.unionByName(quality.max_length(logged_run(t, p, jobs), "execution_log", MAX_LENGTHS["execution_log"]))


#: Which part of a table's rows a file holds, by its key.
PARTED = {"orders": "order_id", "order_items": "order_id", "customers": "cust_id"}


def incremental_mart(t: Tables, p: Params, files: int = 4) -> DataFrame:
    """The metric mart from kept states: the tables are written as ``files``
    parts, all but the last are counted, then the last one is added. Every task
    of a scan writes its rows of a part as a file of its own."""
    spark = t.orders.sparkSession
    with _folder(spark) as root:
        paths = {name: f"{root}/{name}" for name in PARTED}

        def add(part: int) -> None:
            for name, key in PARTED.items():
                rows = t.get(name)
                mine = F.coalesce(F.pmod(F.col(key), F.lit(files)), F.lit(0)) == part
                rows.where(mine).write.mode("append").parquet(paths[name])

        for part in range(files - 1):
            add(part)
        metrics.update(spark, paths, f"{root}/states", catalog.REGISTRY, t.unique_keys)
        add(files - 1)
        metrics.update(spark, paths, f"{root}/states", catalog.REGISTRY, t.unique_keys)
        return materialize(metrics.current(spark, paths, f"{root}/states", catalog.REGISTRY, t.unique_keys))
