"""Metrics from registry rows, and their states kept by file."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shopsight import published
from shopsight.params import Params
from shopsight.plans import catalog, governance, metrics
from shopsight.plans.metrics import Metric, from_rows
from shopsight.sources.business import write_parquet_tables
from shopsight.sources.star_schema import tables_from_star
from shopsight.sources.tables import Tables
from tests.conftest import SF001

P = Params()


def _rows(df):
    return sorted(map(tuple, df.select("metric", "entity_type", "entity_id", "value").collect()), key=str)


@pytest.fixture(scope="module")
def t(spark):
    return tables_from_star(spark, SF001)


def test_a_new_row_is_a_new_metric(spark, t):
    rows = spark.createDataFrame([
        ("big_orders", "Sales", "d", "f", "s", "orders", "distinct", "cust_id", None, "total_amount > 200", "store", "store_id"),
        ("units_per_line", "Product", "d", "f", "s", "order_items", "ratio", "quantity", "order_id", None, None, None),
        ("spent", "Store", "d", "f", "s", "expenses", "sum", "amount", None, None, "store", "store_id"),
    ], "kpi_name string, kpi_category string, description string, formula string, source_tables string, table_name string, "
       "measure string, column_name string, per_column string, row_filter string, entity_type string, entity_column string")
    got = _rows(metrics.mart(t, from_rows(rows.collect())))
    big = t.orders.where("total_amount > 200").groupBy("store_id").agg(F.count_distinct("cust_id").alias("v"))
    want = [("big_orders", "store", r.store_id, r.v) for r in big.collect()]
    s, n = t.order_items.agg(F.sum("quantity"), F.count("order_id")).first()
    want.append(("units_per_line", "all", None, round(s / n, 6)))
    want += [("spent", "store", r[0], r[1]) for r in t.expenses.groupBy("store_id").agg(F.sum("amount")).collect()]
    key = lambda r: (r[0], r[1], r[2], round(float(r[3]), 5))
    assert sorted(map(key, got), key=str) == sorted(map(key, want), key=str)


@pytest.mark.parametrize("wrong", [dict(kind="median"), dict(kind="ratio"), dict(per="order_id"), dict(table="nowhere")])
def test_rows_that_say_nothing_are_refused(wrong):
    with pytest.raises(ValueError):
        Metric(**{**dict(name="m", category="", description="", formula="", sources="", table="orders", kind="sum",
                         column="total_amount"), **wrong})


def test_one_scan_a_table(spark, t):
    plan = catalog.metric_mart(t)._jdf.queryExecution().executedPlan().toString()
    scans = [x for x in plan.splitlines() if "FileScan" in x]
    assert sum("o_totalprice" in x for x in scans) == 1 and sum("l_quantity" in x for x in scans) == 1


def _empty(t):
    return Tables(**{n: t.get(n).limit(0) for n in ("orders", "order_items", "products", "inventory", "stores", "expenses",
                                                    "customers")})


def test_empty_tables(spark, t):
    got = _rows(catalog.metric_mart(_empty(t)))
    assert [(r[0], r[3]) for r in got] == [("avg_order_value", None), ("customer_count", 0), ("order_count", 0), ("total_revenue", None)]


def test_nulls_and_repeats(spark, t):
    """An undeclared key is counted once; NULL entities are a group, NULL values count nowhere."""
    some = t.orders.orderBy("order_id").limit(50)
    odd = some.withColumns({"cust_id": F.lit(None).cast("long"), "total_amount": F.when(F.col("order_id") % 2 == 0, F.col("total_amount")),
                            "store_id": F.lit(77).cast("long")})
    frames = {n: t.get(n) for n in ("order_items", "products", "inventory", "stores", "expenses", "customers")}
    u = Tables(orders=t.orders.unionByName(some).unionByName(odd), **frames)
    got = {(r[0], r[2]): r[3] for r in _rows(catalog.metric_mart(u))}
    o = u.orders
    assert got["order_count", None] == o.select("order_id").distinct().count()
    assert got["customer_lifetime_value", None] == o.where("cust_id is null").agg(F.sum("total_amount")).first()[0]
    assert got["store_revenue", 77] == o.where("store_id = 77").agg(F.sum("total_amount")).first()[0]


@pytest.fixture
def kept(spark, t):
    root = tempfile.mkdtemp(prefix="shopsight-states-")
    paths = {n: f"{root}/{n}" for n in ("orders", "order_items", "customers")}
    return paths, f"{root}/states"


def _add(t, paths, part, parts=3):
    for n, key in (("orders", "order_id"), ("order_items", "order_id"), ("customers", "cust_id")):
        rows = t.get(n).where(F.pmod(F.col(key), F.lit(parts)) == part)
        rows.coalesce(1).write.mode("append").parquet(paths[n])


def _files_read(spark, monkeypatch):
    read = []
    plain = metrics.states

    def noted(rows, *a, **kw):
        read.extend(rows.inputFiles())
        return plain(rows, *a, **kw)

    monkeypatch.setattr(metrics, "states", noted)
    return read


def test_a_new_file_is_read_alone(spark, t, kept, monkeypatch):
    paths, root = kept
    full = _rows(catalog.metric_mart(t))
    for part in (0, 1):
        _add(t, paths, part)
    read = _files_read(spark, monkeypatch)
    assert len(metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys)) == 6 and len(read) == 6
    before = set(read)
    read.clear()
    _add(t, paths, 2)
    new = metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys)
    assert len(new) == 3 and len(read) == 3 and not before & set(read)
    assert _rows(metrics.current(spark, paths, root, catalog.REGISTRY, t.unique_keys)) == full
    # nothing new: nothing is read
    read.clear()
    assert metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys) == [] and not read


def test_without_a_declared_key(spark, t, kept):
    """One order in two files is one order: the files' bitmaps merge."""
    paths, root = kept
    for part in (0, 1, 2):
        _add(t, paths, part)
        metrics.update(spark, paths, root, catalog.REGISTRY)
    t.orders.orderBy("order_id").limit(20).coalesce(1).write.mode("append").parquet(paths["orders"])
    metrics.update(spark, paths, root, catalog.REGISTRY)
    got = {r[0]: r[3] for r in _rows(metrics.current(spark, paths, root, catalog.REGISTRY)) if r[1] == "all"}
    assert got["order_count"] == t.orders.count() and got["customer_count"] == t.customers.count()


def test_replaced_and_removed_files(spark, t, kept):
    paths, root = kept
    for part in (0, 1, 2):
        _add(t, paths, part)
    metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys)
    gone = next(n for n in sorted(os.listdir(paths["orders"])) if n.startswith("part-"))
    rows = spark.read.parquet(f"{paths['orders']}/{gone}").limit(7).collect()
    schema = t.orders.schema
    os.remove(f"{paths['orders']}/{gone}")
    os.remove(f"{paths['orders']}/.{gone}.crc")
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(paths["orders"])
    left = Tables(orders=spark.read.parquet(paths["orders"]), unique_keys=t.unique_keys, **{n: t.get(n) for n in (
        "order_items", "products", "inventory", "stores", "expenses", "customers")})
    assert len(metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys)) == 1
    assert _rows(metrics.current(spark, paths, root, catalog.REGISTRY, t.unique_keys)) == _rows(catalog.metric_mart(left))


@pytest.mark.parametrize("more", [0, 1])
def test_a_crash_before_the_log_counts_once(spark, t, kept, monkeypatch, more):
    paths, root = kept
    _add(t, paths, 0, parts=1)
    once = published.append_once

    def dies(spark_, path, *a):
        if path.endswith("/files"):
            raise KeyboardInterrupt
        return once(spark_, path, *a)

    with monkeypatch.context() as m:
        m.setattr(published, "append_once", dies)
        with pytest.raises(KeyboardInterrupt):
            metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys)
    # a file more makes another batch: the states of the dead one don't count
    if more:
        t.customers.limit(0).coalesce(1).write.mode("append").parquet(paths["customers"])
    assert len(metrics.update(spark, paths, root, catalog.REGISTRY, t.unique_keys)) == 3 + more
    assert _rows(metrics.current(spark, paths, root, catalog.REGISTRY, t.unique_keys)) == _rows(catalog.metric_mart(t))


def test_date_partitioned_orders(spark, t):
    root = tempfile.mkdtemp(prefix="shopsight-states-")
    write_parquet_tables(t, f"{root}/tables", partition_orders_by_date=True)
    paths = {n: f"{root}/tables/{n}" for n in ("orders", "order_items", "customers")}
    few = {"orders": paths["orders"]}
    own = [m for m in catalog.REGISTRY if m.table == "orders"]
    metrics.update(spark, few, f"{root}/states", own, t.unique_keys)
    assert _rows(metrics.current(spark, few, f"{root}/states", own, t.unique_keys)) == _rows(metrics.mart(t, own))


def test_the_incremental_mart_is_written_by_all_tasks_of_a_scan(spark, t, monkeypatch):
    """No task writes a whole part of a table: with the files of four scan tasks the mart is the same."""
    written = []

    def update(spark, paths, *args):
        written.append({n: spark.read.parquet(p).select("_metadata.file_path").distinct().count() for n, p in paths.items()})
        return real(spark, paths, *args)

    real = metrics.update
    monkeypatch.setattr(metrics, "update", update)
    spread = t.replaced(**{n: t.get(n).repartition(4) for n in governance.PARTED})
    got = governance.incremental_mart(spread, P)
    assert _rows(got) == _rows(catalog.metric_mart(t))
    assert [set(w.values()) for w in written] == [{12}, {16}]
