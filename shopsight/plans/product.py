"""Product KPIs 13-14.

Both use ``products LEFT JOIN order_items LEFT JOIN orders ON ... AND status
valid``: the status test sits in the second join's ON clause, so lines of
excluded orders still add to units and revenue while the distinct order
count skips them. ``item_lines(valid_only=False)`` keeps exactly that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shopsight.functions.semantics import div_round, money, pct, stock_status
from shopsight.operators.ranking import desc, rank_window
from shopsight.params import Params
from shopsight.plans.sales import category_sales, product_sales_rollup
from shopsight.sources.tables import Tables


def product_sales_all_status(t: Tables, p: Params, marts=None) -> DataFrame:
    """Per prod_id over all lines of existing products (status ignored for sums)."""
    return product_sales_rollup(t, p, False, "net", marts)


def inventory_by_product(t: Tables) -> DataFrame:
    return t.inventory.groupBy("prod_id").agg(
        F.sum("stock_qty").alias("current_stock"),
        F.count_distinct("store_id").alias("stores_stocked"),
    )


def product_performance(t: Tables, p: Params = Params(), marts=None,
                        sort: bool = True) -> DataFrame:
    """KPI 13: per product; rank within category on unrounded revenue, NULLS LAST."""
    ps = product_sales_all_status(t, p, marts).withColumnRenamed("value", "rev")
    inv = inventory_by_product(t)
    prods = t.products.select("prod_id", "prod_name", "category", "brand", "price")
    j = prods.join(ps, "prod_id", "left").join(inv, "prod_id", "left")
    ranked = rank_window(
        j,
        [desc("rev", nulls_first=False)],
        outputs={"category_rank": "rank"},
        partition_by=["category"],
        tiebreak=["prod_id"],
        bucket_rows=p.rank_bucket_rows,
    )
    stock = F.coalesce(F.col("current_stock"), F.lit(0))
    out = ranked.select(
        "prod_id", "prod_name", "category", "brand",
        F.col("price").alias("list_price"),
        F.coalesce(F.col("units"), F.lit(0)).cast("long").alias("units_sold"),
        money(F.coalesce(F.col("rev"), F.lit(0))).alias("revenue"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("order_count"),
        stock.cast("long").alias("current_stock"),
        F.col("stores_stocked").cast("long"),
        "category_rank",
        stock_status(stock).alias("stock_status"),
        F.col("rev").alias("_rev"),
    )
    if sort:
        out = out.orderBy(F.col("_rev").desc_nulls_last(), "prod_id")
    return out.drop("_rev")


def category_performance(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 14: per category, unsold products counted; share of all revenue.

    One pass over the lines (all statuses), or the category mart in a full
    run: grouped per (category, order_id) — clustered already by the order
    join — and then per category. Product counts come from the products table, so
    categories and products without sales stay in. The share window runs
    over one row per category.
    """
    per_cat = category_sales(t, p, False, "net", marts).withColumnRenamed("value", "rev")
    counts = t.products.groupBy("category").agg(F.count_distinct("prod_id").alias("product_count"))
    g = counts.join(per_cat, counts["category"].eqNullSafe(per_cat["category"]), "left").select(
        counts["category"], "product_count", "units", "rev", "price_sum", "price_n", "n_orders"
    )
    g = g.withColumn("total", F.sum("rev").over(Window.partitionBy()))
    return g.select(
        "category",
        F.col("product_count").cast("long"),
        F.col("units").cast("long").alias("total_units_sold"),
        money("rev").alias("revenue"),
        div_round("price_sum", "price_n", 2, num_scale=2).alias("avg_price"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("order_count"),
        pct("rev", "total", 1, num_scale=6, den_scale=6).alias("pct_of_revenue"),
    ).orderBy(F.col("revenue").desc_nulls_first(), "category")
