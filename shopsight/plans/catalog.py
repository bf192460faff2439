"""Metric catalog: the seven catalog formulas as a long-format metric mart.

Each metric yields rows ``(metric, entity_type, entity_id, value)``; the mart
is their union, written partitioned by ``metric``. The formulas follow the
catalog text, which differs from the KPI of similar name (e.g. total revenue
keeps Returned orders, order count has no status filter). The jobs are made of
the registry's rows (``metrics.py``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopsight.plans import metrics
from shopsight.plans.metrics import Metric
from shopsight.sources.tables import Tables

# The registry rows (name, category, description, formula, sources) and what they are computed from.
REGISTRY = [
    Metric("total_revenue", "Sales", "Total revenue from all completed orders",
           "SUM(total_amount) WHERE status != 'Cancelled'", "sales.orders",
           "orders", "sum", "total_amount", where="order_status != 'Cancelled'"),
    Metric("order_count", "Sales", "Total number of orders",
           "COUNT(DISTINCT order_id)", "sales.orders",
           "orders", "distinct", "order_id"),
    Metric("avg_order_value", "Sales", "Average value per order",
           "SUM(total_amount) / COUNT(order_id)", "sales.orders",
           "orders", "ratio", "total_amount", per="order_id"),
    Metric("customer_lifetime_value", "Customer", "Total revenue per customer",
           "SUM(total_amount) GROUP BY cust_id", "sales.orders, customers.customers",
           "orders", "sum", "total_amount", entity=("customer", "cust_id")),
    Metric("customer_count", "Customer", "Total unique customers",
           "COUNT(DISTINCT cust_id)", "customers.customers",
           "customers", "distinct", "cust_id"),
    Metric("store_revenue", "Store", "Revenue by store",
           "SUM(total_amount) GROUP BY store_id", "sales.orders, stores.stores",
           "orders", "sum", "total_amount", entity=("store", "store_id")),
    Metric("product_sales", "Product", "Units sold by product",
           "SUM(quantity) GROUP BY prod_id", "sales.order_items, products.products",
           "order_items", "sum", "quantity", entity=("product", "prod_id")),
]


def metric_job(m: Metric):
    """The job of one registry row by itself."""
    return lambda t: metrics.mart(t, [m])


METRICS = {f"metric_{m.name}": metric_job(m) for m in REGISTRY}


def metric_mart(t: Tables, rows: list[Metric] | None = None) -> DataFrame:
    """All metrics of the registry in long format, with one scan a table."""
    return metrics.mart(t, REGISTRY if rows is None else rows)


def _text(m: Metric) -> tuple[str, ...]:
    return m.name, m.category, m.description, m.formula, m.sources


def registry(spark: SparkSession, owner: str | None = None,
             created_at: dt.datetime | None = None) -> DataFrame:
    """The metric registry (kpi_metadata) as a small DataFrame: 7 fixed rows."""
    created = created_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)  # TIMESTAMP_NTZ: UTC wall clock
    if owner is None:  # DEFAULT CURRENT_USER
        try:
            owner = spark.sparkContext.sparkUser()
        except Exception:  # Spark Connect: no SparkContext
            owner = spark.sql("SELECT current_user()").first()[0]
    who = owner
    rows = [(i + 1, *_text(m), who, created) for i, m in enumerate(REGISTRY)]
    return spark.createDataFrame(
        rows,
        "kpi_id INT, kpi_name STRING, kpi_category STRING, description STRING, formula STRING, "
        "source_tables STRING, owner STRING, created_at TIMESTAMP_NTZ",
    )


def metric_catalog(t: Tables) -> DataFrame:
    """The metric mart with each metric's registry entry attached by name
    (the 7 fixed registry rows are broadcast: a fixed-size side)."""
    spark = t.orders.sparkSession
    reg = spark.createDataFrame(
        [(i, *_text(m)) for i, m in enumerate(REGISTRY, 1)],
        "kpi_id INT, metric STRING, kpi_category STRING, description STRING, formula STRING, source_tables STRING",
    )
    return metric_mart(t).join(F.broadcast(reg), "metric", "left").select(
        "kpi_id", "metric", "kpi_category", "description", "formula", "source_tables", "entity_type", "entity_id", "value"
    )
