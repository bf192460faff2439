"""Sales KPIs 1-6."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from shopsight.functions.semantics import as_of_date, div_round, money, pct
from shopsight.operators.distinct import counted, states
from shopsight.params import Params
from shopsight.plans.marts import line_measures, order_rollup, region_measures, valid_orders
from shopsight.sources.tables import Tables


def sales_overview(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 1: one row; empty input gives NULL money and 0 counts."""
    return order_rollup(t, p, [], marts).select(
        money("amount").alias("total_revenue"),
        F.col("n_orders").alias("total_orders"),
        F.col("n_customers").alias("total_customers"),
        div_round("amount", "n_amount", 2, num_scale=2).alias("avg_order_value"),
        div_round("amount", "n_customers", 2, num_scale=2).alias("revenue_per_customer"),
    )


def monthly_data(t: Tables, p: Params, marts=None) -> DataFrame:
    return order_rollup(t, p, ["month"], marts).select(
        F.col("month").alias("month_date"), F.col("amount").alias("rev"), F.col("n_orders").alias("orders"),
        F.col("n_customers").alias("customers"))


def monthly_revenue_trend(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 2: LAG to the previous month that has sales; growth on unrounded revenue.

    The window runs over one row per calendar month (bounded by the date
    range, not by the data volume), so its single partition is harmless.
    """
    m = monthly_data(t, p, marts)
    prev = F.lag("rev").over(Window.orderBy(F.col("month_date").asc_nulls_last()))
    m = m.withColumn("prev", prev)
    return m.select(
        F.date_format("month_date", "MMM yyyy").alias("month_label"),
        "month_date",
        money("rev").alias("revenue"),
        "orders",
        "customers",
        div_round("rev", "orders", 2, num_scale=2).alias("aov"),
        pct(F.col("rev") - F.col("prev"), "prev", 1, num_scale=2, den_scale=2).alias(
            "mom_growth_pct"
        ),
    ).orderBy(F.col("month_date").asc_nulls_last())


def from_totals(totals: DataFrame, key: str, valid_only: bool, measure: str) -> DataFrame:
    """The rollup columns (value, units, n_orders, price_sum, price_n) of one
    variant from a ``line_totals`` mart; valid-only keeps keys with a valid
    order (the inner join's rows)."""
    sfx = "ok" if valid_only else "all"
    out = totals.select(
        key,
        F.col(f"{measure}_{sfx}").alias("value"),
        F.col(f"q_{sfx}").alias("units"),
        F.col("n_orders_ok").alias("n_orders"),
        F.col(f"up_{sfx}").alias("price_sum"),
        F.col(f"nup_{sfx}").alias("price_n"),
    )
    return out.filter(F.col("n_orders") > 0) if valid_only else out


def category_sales(t: Tables, p: Params, valid_only: bool, measure: str, marts=None) -> DataFrame:
    """Per-category rollup: from the category mart in a full run, else from lines."""
    if marts is not None:
        return from_totals(marts.category_totals(), "category", valid_only, measure)
    return lines_rollup(line_measures(t, p, True, valid_only), "category", valid_only, measure)


def product_sales_rollup(t: Tables, p: Params, valid_only: bool, measure: str,
                         marts=None) -> DataFrame:
    """Per-product rollup: from the product mart in a full run, else from lines."""
    if marts is not None:
        return from_totals(marts.product_totals(), "prod_id", valid_only, measure)
    return lines_rollup(line_measures(t, p, False, valid_only), "prod_id", valid_only, measure)


def lines_rollup(lines: DataFrame, key: str, valid_only: bool, measure: str) -> DataFrame:
    """Per ``key`` (category or prod_id) from line rows.

    ``COUNT(DISTINCT order_id)`` per key needs (key, order_id) pairs; the
    lines come out of the order join hash-partitioned by order_id, which
    already clusters that first grouping, so only the small second level
    shuffles.
    """
    if valid_only:
        lines = lines.filter("ok")
    per_order = lines.groupBy(key, "order_id").agg(
        F.sum(measure).alias("v"),
        F.sum("q").alias("q"),
        F.sum("up").alias("up"),
        F.sum("nup").alias("nup"),
        F.max(F.col("ok") & F.col("order_id").isNotNull()).alias("ok"),
    )
    return per_order.groupBy(key).agg(
        F.sum("v").alias("value"),
        F.sum("q").alias("units"),
        F.count_if("ok").alias("n_orders"),
        F.sum("up").alias("price_sum"),
        F.sum("nup").alias("price_n"),
    )


def revenue_by_category(t: Tables, p: Params = Params(), measure: str = "net",
                        marts=None) -> DataFrame:
    """KPI 3 (NET revenue). ``measure='gross'`` gives export 3's variant.

    Aggregating per category first makes the share-of-total window run over
    one row per category.
    """
    g = category_sales(t, p, True, measure, marts)
    scale = 6 if measure == "net" else 2
    total = F.sum("value").over(Window.partitionBy())
    g = g.withColumn("total", total)
    return g.select(
        "category",
        money("value").alias("revenue"),
        F.col("units").cast("long").alias("units_sold"),
        F.col("n_orders").cast("long").alias("order_count"),
        pct("value", "total", 1, num_scale=scale, den_scale=scale).alias("pct_of_total"),
    ).orderBy(F.col("revenue").desc_nulls_first(), "category")


def revenue_by_region(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 4: inner join, so stores without valid orders are not counted."""
    return region_measures(t, p, marts).select(
        "region",
        F.col("n_stores").cast("long").alias("store_count"),
        money("amount").alias("revenue"),
        F.col("n_orders").alias("orders"),
        F.col("n_customers").alias("customers"),
        div_round("amount", "n_amount", 2, num_scale=2).alias("avg_order_value"),
    ).orderBy(F.col("revenue").desc_nulls_first(), "region")


def daily_sales_30d(t: Tables, p: Params = Params()) -> DataFrame:
    """KPI 5: days >= as_of - window_days (no upper bound); the moving average
    covers the previous 6 *rows* (days with sales), filtered first."""
    v = valid_orders(t, p).filter(
        F.col("order_date") >= F.date_sub(as_of_date(p.as_of), p.window_days)
    )
    d = v.groupBy(F.col("order_date").alias("sale_date")).agg(
        F.sum("total_amount").alias("rev"),
        t.distinct_count("orders", "order_id").alias("orders"),
    )
    # One row per day in the window: the unpartitioned window is bounded.
    w = Window.orderBy("sale_date").rowsBetween(-(p.moving_avg_rows - 1), 0)
    d = d.withColumns({"ws": F.sum("rev").over(w), "wc": F.count("rev").over(w)})
    return d.select(
        "sale_date",
        F.date_format("sale_date", "E").alias("day_name"),
        money("rev").alias("revenue"),
        F.col("orders").cast("long"),
        div_round("ws", "wc", 2, num_scale=2).alias("moving_avg_7d"),
    ).orderBy("sale_date")


def product_revenue(t: Tables, p: Params, measure: str = "net", marts=None) -> DataFrame:
    """Per existing product over lines of valid orders: value, units, prices.
    Orders are not counted here, so the lines are added up per product at once."""
    if marts is not None:
        sums = from_totals(marts.product_totals(), "prod_id", True, measure)
    else:
        sums = line_measures(t, p, False, True).filter("ok").groupBy("prod_id").agg(
            F.sum(measure).alias("value"), F.sum("q").alias("units"), F.sum("up").alias("price_sum"),
            F.sum("nup").alias("price_n"))
    return sums.join(t.products.select("prod_id"), "prod_id", "left_semi")


def _sent(top: DataFrame, p: Params) -> DataFrame:
    """The top_n rows, as a broadcast if they are few."""
    return F.broadcast(top) if p.top_n <= 10_000 else top


def orders_of(t: Tables, p: Params, chosen: DataFrame) -> DataFrame:
    """``chosen`` (top_n products, with prod_id) and ``n_orders``, their distinct
    valid orders: only lines of these products meet the orders."""
    columns = chosen.columns
    lines = t.order_items.select("prod_id", "order_id").join(_sent(chosen, p), "prod_id")
    lines = lines.join(valid_orders(t, p).select("order_id"), "order_id")
    return counted(states(lines, columns, {"n_orders": "order_id"}), columns, ["n_orders"], [])


def top_products(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 6: top ``n`` products by rounded NET revenue (ties: prod_id).

    Revenue per existing product is cut to the top n with a distributed top-k
    (TakeOrderedAndProject). Only the n winners have their orders counted and
    meet the product names, so no grouping has a row per product and order.
    """
    sums = product_revenue(t, p, marts=marts).select(
        "prod_id",
        F.col("units").cast("long").alias("units_sold"),
        money("value").alias("revenue"),
        div_round("price_sum", "price_n", 2, num_scale=2).alias("avg_selling_price"),
        *([F.col("n_orders")] if marts is not None else []),
    )
    top = sums.orderBy(F.col("revenue").desc_nulls_first(), "prod_id").limit(p.top_n)
    if marts is None:
        top = orders_of(t, p, top)
    names = t.products.select("prod_id", "prod_name", "category", "brand")
    return (
        _sent(top, p).join(names, "prod_id", "inner")
        .select("prod_id", "prod_name", "category", "brand", "units_sold", "revenue",
                F.col("n_orders").cast("long").alias("order_count"), "avg_selling_price")
        .orderBy(F.col("revenue").desc_nulls_first(), "prod_id")
    )
