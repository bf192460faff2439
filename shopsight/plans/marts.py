"""Shared intermediate results (marts) of the KPI jobs.

Each mart is a DataFrame definition; ``Marts(persist=True)`` persists them
(MEMORY_AND_DISK) so a full run computes each once; a lost block is rebuilt
from the sources with the same result. ``Marts.release`` unpersists them at
the end of the run.
"""

from __future__ import annotations

import inspect

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from shopsight.functions.semantics import as_of_date, is_valid, money, net_value
from shopsight.operators.distinct import counted, merged, states
from shopsight.operators.quality import Watch, domain_check, null_check
from shopsight.params import DISCOUNTS, ORDER_STATUSES, Params
from shopsight.sources.tables import Tables


def valid_orders(t: Tables, p: Params) -> DataFrame:
    """Orders whose status is not excluded (NULL status excluded too)."""
    return t.orders.filter(is_valid("order_status", p.excluded_statuses))


def customer_orders(t: Tables, p: Params) -> DataFrame:
    """Per cust_id over valid orders: the order-side half of KPIs 7-10.

    Aggregating before the customer join is exact because cust_id is the
    customers key; partial aggregation collapses a hot customer map-side.
    """
    v = valid_orders(t, p)
    return v.groupBy("cust_id").agg(
        t.distinct_count("orders", "order_id").alias("n_orders"),
        F.count("order_id").alias("n_order_ids"),
        F.sum("total_amount").alias("amount"),
        F.count("total_amount").alias("n_amount"),
        F.min("order_date").alias("first_order"),
        F.max("order_date").alias("last_order"),
        F.datediff(as_of_date(p.as_of), F.max("order_date")).cast("long").alias("recency_days"),
    )


#: Sums that the order states carry, by name.
ORDER_SUMS = ("n_order_rows", "amount", "n_amount")


def order_states(t: Tables, p: Params, keys: tuple[str, ...] = ("store_id", "month")) -> DataFrame:
    """Valid orders per ``keys`` as mergeable states (``operators/distinct.py``):
    distinct customers and orders, revenue. KPIs 1, 2, 4, 11 and 12 and their
    exports roll them up, so a full run reads the orders once for all of them.

    A declared order_id key is counted, not kept as a bitmap.
    """
    v = valid_orders(t, p).select(
        "store_id", "cust_id", "order_id", F.trunc("order_date", "month").alias("month"), "total_amount")
    sums = {"n_order_rows": F.when(F.col("order_id").isNotNull(), 1).otherwise(0).cast("long"), "amount": F.col("total_amount"),
            "n_amount": F.when(F.col("total_amount").isNotNull(), 1).otherwise(0).cast("long")}
    return states(v, list(keys), _distincts(t), sums)


def _distincts(t: Tables) -> dict[str, str]:
    known = t.unique_keys.get("orders") == "order_id"
    return {"n_customers": "cust_id"} | ({} if known else {"n_orders": "order_id"})


def _order_counts(t: Tables, df: DataFrame, keys: list[str], also: tuple[str, ...] = ()) -> DataFrame:
    """(keys, n_orders, n_customers, sums) of states merged to ``keys``."""
    out = counted(df, keys, [*_distincts(t), *also], list(ORDER_SUMS))
    if "n_orders" not in out.columns:
        out = out.withColumn("n_orders", F.col("n_order_rows"))
    # one sum is DECIMAL(22,2), the type of the sum over the orders themselves
    return out.withColumns({"amount": F.col("amount").cast("decimal(22,2)"), **{
        c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_orders", "n_order_rows", "n_amount")}})


def order_rollup(t: Tables, p: Params, keys: list[str], marts: Marts | None = None) -> DataFrame:
    """Per ``keys`` (of store_id and month, or none): orders, distinct customers,
    revenue; from the run's states, or from the orders if a job runs by itself."""
    if marts is not None:
        df = merged(marts.order_states(), keys, list(ORDER_SUMS))
    else:
        df = order_states(t, p, tuple(keys))
    return _order_counts(t, df, keys)


def store_orders(t: Tables, p: Params, marts: Marts | None = None) -> DataFrame:
    """Per store_id over valid orders: orders, distinct customers, revenue."""
    return order_rollup(t, p, ["store_id"], marts)


def region_measures(t: Tables, p: Params, marts: Marts | None = None) -> DataFrame:
    """Per region over valid orders of known stores: stores, orders, customers,
    revenue. The regions join states, never orders, and merge by (region, word
    of the bitmap), so no shuffle of any size is keyed by the few regions."""
    df = marts.order_states() if marts is not None else order_states(t, p, ("store_id",))
    df = df.join(t.stores.select("store_id", "region"), "store_id")
    df = merged(df, ["region"], list(ORDER_SUMS), also={"n_stores": "store_id"})
    return _order_counts(t, df, ["region"], also=("n_stores",))


def order_rollups(t: Tables, p: Params, marts: Marts | None = None) -> DataFrame:
    """Every level at once, from one pass over the orders: the total, months,
    regions and stores (``level`` names them; the columns of others are NULL)."""
    df = marts.order_states() if marts is not None else order_states(t, p)
    stores = t.stores.select("store_id", "region", F.lit(True).alias("known"))
    df = df.join(stores, "store_id", "left")

    def level(name: str, *kept: str) -> Column:
        kinds = {"month": "date", "region": "string", "store_id": "bigint"}
        return F.struct(F.lit(name).alias("level"),
                        *((F.col(c) if c in kept else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()))

    known = F.col("known").isNotNull()
    levels = F.array(level("total"), level("month", "month"), F.when(known, level("region", "region")),
                     F.when(known, level("store", "store_id")))
    df = df.select(F.explode(levels).alias("at"), "of", "word", "bits", *ORDER_SUMS).where(F.col("at").isNotNull()).select(
        "at.*", "of", "word", "bits", *ORDER_SUMS)
    keys = ["level", "month", "region", "store_id"]
    return _order_counts(t, merged(df, keys, list(ORDER_SUMS)), keys).select(
        *keys, "n_orders", "n_customers", money("amount").alias("revenue"))


def item_lines(t: Tables, p: Params, valid_only: bool, items: DataFrame | None = None) -> DataFrame:
    """Order lines joined to order ids.

    ``valid_only``: inner join with valid orders (KPI 3, 6, exports 3, 6).
    Otherwise a left join that only flags validity: lines of excluded orders
    still count for units and revenue (KPI 13, 14), exactly as the LEFT JOIN
    with the status test in its ON clause does.
    """
    # The two largest tables meet here. No join is forced: a sort-merge join
    # spills at any size, and AQE makes it a hash join where the measured
    # partitions are small enough. Either way the output stays
    # hash-partitioned by order_id for the groupings that follow.
    v = valid_orders(t, p).select("order_id", F.lit(True).alias("_valid"))
    if items is None:
        items = t.order_items.select("order_id", "prod_id", "quantity", "unit_price", "discount")
    how = "inner" if valid_only else "left"
    joined = items.join(v, "order_id", how)
    if not valid_only:
        # lines without an order id can't match: they don't go to the join,
        # where all of them would meet in one partition
        joined = items.where(F.col("order_id").isNotNull()).join(v, "order_id", how).unionByName(
            items.where(F.col("order_id").isNull()).withColumn("_valid", F.lit(None).cast("boolean")))
    return joined.withColumns(
        {
            "net": net_value(),
            "gross": F.col("quantity") * F.col("unit_price"),
            "valid_order_id": F.when(F.col("_valid"), F.col("order_id")),
        }
    ).drop("_valid")


def line_measures(t: Tables, p: Params, with_category: bool = True,
                  valid_only: bool = False) -> DataFrame:
    """Order lines of existing products with their category and validity.

    Columns: prod_id, category, order_id, q, net, gross, up, nup, ok (the
    measures ``line_totals`` sums). Products
    are attached first and the order join last, so rows come out
    hash-partitioned by order_id and the (key, order_id) groupings downstream
    need no further line-sized shuffle. Validity is a property of the order:
    valid-only measures are the rows with ``ok``.

    Per-product jobs pass ``with_category=False``: they attach products after
    aggregating (product-grain rows), saving the line-sized prod_id shuffle;
    lines of unknown products are then dropped by that later join.
    ``valid_only`` inner-joins the valid orders (KPI 3, 6, exports 3, 6): the
    join drops the other lines instead of flagging them.
    """
    items = t.order_items.select("order_id", "prod_id", "quantity", "unit_price", "discount")
    if with_category:
        items = items.join(t.products.select("prod_id", "category"), "prod_id", "inner")
    lines = item_lines(t, p, valid_only=valid_only, items=items)
    return lines.select(
        "prod_id", *(["category"] if with_category else []), "order_id",
        F.col("quantity").alias("q"),
        "net",
        "gross",
        F.col("unit_price").alias("up"),
        F.when(F.col("unit_price").isNotNull(), 1).otherwise(0).alias("nup"),
        F.col("valid_order_id").isNotNull().alias("ok"),
    )


MEASURES = ("q", "net", "gross", "up", "nup")


def line_totals(lines: DataFrame, key: str) -> DataFrame:
    """Per ``key`` (prod_id or category): every line measure over all lines
    (``<m>_all``) and over lines of valid orders (``<m>_ok``), plus the number
    of distinct valid orders (``n_orders_ok``).

    One row per key serves both the valid-only KPIs (3, 6, exports 3, 6) and
    the all-status ones (13, 14). The (key, order_id) level needs no shuffle:
    the lines come out of the order join hash-partitioned by order_id.
    """
    per_order = lines.groupBy(key, "order_id").agg(
        *[F.sum(m).alias(m) for m in MEASURES],
        F.max(F.col("ok") & F.col("order_id").isNotNull()).alias("ok"),
    )
    aggs = []
    for m in MEASURES:
        aggs += [F.sum(m).alias(f"{m}_all"), F.sum(F.when(F.col("ok"), F.col(m))).alias(f"{m}_ok")]
    return per_order.groupBy(key).agg(*aggs, F.count_if("ok").alias("n_orders_ok"))


def product_totals(t: Tables, p: Params) -> DataFrame:
    """``line_totals`` per product (products attached later, per product)."""
    return line_totals(line_measures(t, p, with_category=False), "prod_id")


def category_totals(t: Tables, p: Params) -> DataFrame:
    """``line_totals`` per category (lines of unknown products dropped)."""
    return line_totals(line_measures(t, p, with_category=True), "category")


def calling(job, t: Tables, p: Params, marts: Marts | None) -> DataFrame:
    """``job`` with the run's marts, if it can use them."""
    if "marts" in inspect.signature(job).parameters:
        return job(t, p, marts=marts)
    return job(t, p)


#: What a run's first scan of a table is watched for. Unknown discounts count as 0, so they are only reported.
WATCHED = {
    "orders": [null_check("order_id"), null_check("cust_id", strict=False), null_check("store_id", strict=False),
               domain_check("order_status", ORDER_STATUSES)],
    "order_items": [null_check("order_id"), null_check("prod_id"), domain_check("discount", DISCOUNTS, strict=False)],
}


class Marts:
    """Lazily built, optionally persisted marts for one run. ``watch`` checks the
    rows of the scans that the marts are made of."""

    def __init__(self, tables: Tables, params: Params, persist: bool = False, watch: Watch | None = None):
        self.t, self.p, self.persist, self.watch = tables, params, persist, watch
        self._cache: dict[str, DataFrame] = {}

    def _watched(self, table: str) -> Tables:
        if self.watch is None:
            return self.t
        return self.t.replaced(**{table: self.watch.on(self.t.get(table), table, WATCHED[table])})

    def get(self, name: str, build) -> DataFrame:
        """A mart by name, built with ``build(tables, params)`` on first use."""
        return self._get(name, build)

    def _get(self, name: str, build, scans: str | None = None) -> DataFrame:
        if name not in self._cache:
            df = build(self._watched(scans) if scans else self.t, self.p)
            if self.persist:
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._cache[name] = df
        return self._cache[name]

    def customer_orders(self) -> DataFrame:
        return self._get("customer_orders", customer_orders)

    def order_states(self) -> DataFrame:
        return self._get("order_states", order_states, "orders")

    def product_totals(self) -> DataFrame:
        return self._get("product_totals", product_totals, "order_items")

    def category_totals(self) -> DataFrame:
        return self._get("category_totals", category_totals, "order_items")

    def release(self) -> None:
        for df in self._cache.values():
            if self.persist:
                df.unpersist()
        self._cache.clear()
