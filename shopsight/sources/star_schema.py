"""Map the TPC-H-like test star schema onto the seven logical business tables.

The mapping is documented in FIXTURES.md; the oracle SQL in ``oracle/`` uses
the same expressions in DuckDB form. Everything is a projection/filter/join
over the source scans, so Catalyst reads only the needed columns. Every source
row is mapped; entities without sales, stock or expenses come from giving their
rows to the neighbouring key (``neighbour``), not from dropping rows.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from shopsight.sources.tables import Tables

# Fixed values of the fixture mapping (FIXTURES.md).
CANCELLED_CUSTKEY_MOD = 25
ITEM_PARTKEY_IDLE_MOD = 50
NULL_DISCOUNT_LINENUMBER = 7
INVENTORY_IDLE_MOD = 11
INVENTORY_SECOND_STORE_MOD = 6
INVENTORY_STORE_MOD = 10
EXPENSE_IDLE_MOD = 7
JOIN_DATE_BASE = dt.date(1995, 1, 1)
JOIN_DATE_SPAN = 365
AMOUNT_FACTOR = Decimal("0.002")


# Column types of the star tables (TESTDATA.md). Reading with a given schema
# skips Parquet schema inference (one footer-reading job per table per query)
# and pins the zone-less dates to TIMESTAMP_NTZ whatever the session default.
STAR_SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def map_orders(orders: DataFrame, supplier: DataFrame) -> DataFrame:
    # Number of stores that receive orders: a scalar subquery over supplier,
    # evaluated once; leaves the last ~5% of stores idle.
    n = F.count(F.lit(1))
    n_active = supplier.select(
        F.greatest(n - F.expr("count(1) div 20") - 1, F.lit(1)).cast("long")
    ).scalar()
    status = (
        F.when(F.col("o_custkey") % CANCELLED_CUSTKEY_MOD == 0, "Cancelled")
        .when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "Shipped")
        .when(F.col("o_orderpriority") == "5-LOW", "Cancelled")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Returned")
        .otherwise("Processing")
    )
    amount = F.round(
        F.col("o_totalprice").cast("decimal(12,2)") * F.lit(AMOUNT_FACTOR), 2
    ).cast("decimal(12,2)")
    return orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("cust_id"),
        (F.col("o_orderkey") % n_active).alias("store_id"),
        wall_clock_date(orders, "o_orderdate").alias("order_date"),
        status.alias("order_status"),
        amount.alias("total_amount"),
    )


def wall_clock_date(df: DataFrame, column: str):
    """DATE of a wall-clock timestamp column, independent of the session time zone.

    The files store timestamps without a zone. Read as TIMESTAMP_NTZ (the
    default) a cast is exact; if a session reads them as zoned TIMESTAMP, the
    stored value is taken as UTC, so the day is the UTC epoch day.
    """
    c = F.col(column)
    if df.schema[column].dataType.typeName() == "timestamp":
        return F.date_from_unix_date(
            F.call_function("div", F.unix_micros(c), F.lit(86_400_000_000)).cast("int")
        )
    return c.cast("date")


def neighbour(key: str, mod: int):
    """The key, but the one beside it for every ``mod``-th key."""
    c = F.col(key)
    beside = F.when(c == 0, c + 1).otherwise(c - 1)
    return F.when(c % mod == 0, beside).otherwise(c)


def map_order_items(lineitem: DataFrame) -> DataFrame:
    discount = F.when(F.col("l_linenumber") == NULL_DISCOUNT_LINENUMBER, F.lit(None)).otherwise(
        (F.col("l_discount").cast("decimal(4,2)") * 100).cast("decimal(5,2)")
    )
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        neighbour("l_partkey", ITEM_PARTKEY_IDLE_MOD).alias("prod_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
        discount.cast("decimal(5,2)").alias("discount"),
    )


def map_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("prod_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def map_inventory(part: DataFrame) -> DataFrame:
    first = part.select(
        neighbour("p_partkey", INVENTORY_IDLE_MOD).alias("prod_id"),
        (F.col("p_partkey") % INVENTORY_STORE_MOD).alias("store_id"),
        ((F.col("p_size") - 1) * (F.col("p_partkey") % 4).cast("int")).alias("stock_qty"),
    )
    second = part.filter(F.col("p_partkey") % INVENTORY_SECOND_STORE_MOD == 0).select(
        F.col("p_partkey").alias("prod_id"),
        ((F.col("p_partkey") + 1) % INVENTORY_STORE_MOD).alias("store_id"),
        F.col("p_size").alias("stock_qty"),
    )
    return first.unionByName(second).select(
        "prod_id", "store_id", F.col("stock_qty").cast("int").alias("stock_qty")
    )


def map_stores(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    # nation/region are fixed 25/5-row dimensions: broadcasting them is bounded.
    geo = nation.join(
        F.broadcast(region), nation.n_regionkey == region.r_regionkey
    ).select("n_nationkey", "n_name", "r_name")
    return supplier.join(F.broadcast(geo), supplier.s_nationkey == geo.n_nationkey).select(
        F.col("s_suppkey").alias("store_id"),
        F.col("s_name").alias("store_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("region"),
    )


def map_expenses(supplier: DataFrame) -> DataFrame:
    return supplier.select(
        neighbour("s_suppkey", EXPENSE_IDLE_MOD).alias("store_id"),
        F.col("s_acctbal").cast("decimal(12,2)").alias("amount"),
    )


def map_customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(
        F.broadcast(nation.select("n_nationkey", "n_name")),
        customer.c_nationkey == nation.n_nationkey,
    ).select(
        F.col("c_custkey").alias("cust_id"),
        F.col("c_name").alias("full_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        F.date_add(F.lit(JOIN_DATE_BASE), (F.col("c_custkey") % JOIN_DATE_SPAN).cast("int")).alias(
            "join_date"
        ),
    )


def tables_from_star(spark: SparkSession, sf_dir: str) -> Tables:
    """Logical tables over the star schema in ``sf_dir``, built on first use.

    The source keys (o_orderkey, p_partkey, s_suppkey, c_custkey) are the
    primary keys of the star schema, so order_id is declared unique.
    ``operators.quality.key_report`` re-checks this on demand.
    """
    cache: dict[str, DataFrame] = {}

    def star(name: str) -> DataFrame:
        if name not in cache:
            cache[name] = spark.read.schema(STAR_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
        return cache[name]

    return Tables(
        unique_keys={"orders": "order_id"},
        factories={
            "orders": lambda: map_orders(star("orders"), star("supplier")),
            "order_items": lambda: map_order_items(star("lineitem")),
            "products": lambda: map_products(star("part")),
            "inventory": lambda: map_inventory(star("part")),
            "stores": lambda: map_stores(star("supplier"), star("nation"), star("region")),
            "expenses": lambda: map_expenses(star("supplier")),
            "customers": lambda: map_customers(star("customer"), star("nation")),
        },
    )
