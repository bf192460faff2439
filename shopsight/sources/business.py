"""Read and write the seven business tables (Parquet folders or catalog tables).

Layouts for large runs:

* ``partition_orders_by_date``: orders are written partitioned by
  ``order_date``, so date predicates (KPI 5's 30-day window) prune whole
  folders before any file is opened.
* ``write_catalog_tables(..., buckets=n)``: orders and order_items are
  bucketed by ``order_id`` into the same number of buckets, so the largest
  join of the workload (order lines with orders) reads co-located buckets
  and needs no shuffle on either side.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shopsight.sources.tables import SCHEMAS, TABLE_NAMES, Tables


def read_parquet_tables(
    spark: SparkSession, root: str, unique_keys: dict | None = None
) -> Tables:
    """``root/<table>`` Parquet datasets (files or directories) with the logical schemas.

    The schema is given explicitly, so no inference pass runs and a type
    drift in the files fails at read time instead of deep inside a job.
    Tables are read on first use. A date-partitioned orders folder is read
    the same way (the partition column is part of the schema).
    """
    factories = {
        name: (lambda name=name: spark.read.schema(SCHEMAS[name]).parquet(f"{root}/{name}"))
        for name in TABLE_NAMES
    }
    return Tables(unique_keys=dict(unique_keys or {}), factories=factories)


def read_catalog_tables(
    spark: SparkSession, database: str, unique_keys: dict | None = None
) -> Tables:
    """Tables registered in the session catalog as ``database.<table>``
    (bucketing, if any, comes with the table definition)."""
    factories = {name: (lambda name=name: spark.table(f"{database}.{name}")) for name in TABLE_NAMES}
    return Tables(unique_keys=dict(unique_keys or {}), factories=factories)


def write_parquet_tables(tables: Tables, root: str, mode: str = "error",
                         partition_orders_by_date: bool = False) -> None:
    """Persist the logical tables (e.g. the star-schema mapping) as Parquet."""
    for name in TABLE_NAMES:
        w = tables.get(name).write.mode(mode)
        if name == "orders" and partition_orders_by_date:
            w = w.partitionBy("order_date")
        w.parquet(f"{root}/{name}")


def write_catalog_tables(tables: Tables, database: str, location: str | None = None,
                         buckets: int = 0, mode: str = "overwrite") -> None:
    """Save the tables in the session catalog; with ``buckets`` > 0, orders and
    order_items are bucketed (and sorted) by order_id into that many buckets.

    Pick ``buckets`` so one bucket of order_items is a few hundred MB; the
    same number on both tables is what makes the join co-located.
    """
    spark = tables.orders.sparkSession
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for name in TABLE_NAMES:
        w = tables.get(name).write.mode(mode).format("parquet")
        if buckets and name in ("orders", "order_items"):
            w = w.bucketBy(buckets, "order_id").sortBy("order_id")
        w.saveAsTable(f"{database}.{name}")
