"""Store KPIs 11-12."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from shopsight.functions.semantics import div_round, money, pct, tier
from shopsight.operators.ranking import desc, rank_windows
from shopsight.params import STORE_TIER_DEFAULT, Params
from shopsight.plans.marts import region_measures, store_orders
from shopsight.sources.tables import Tables


def store_sales(t: Tables, p: Params, marts=None) -> DataFrame:
    """Every store with its valid-order aggregates and its expenses.

    Orders and expenses are aggregated separately per store_id and then
    attached (no fan-out between them).
    """
    so = store_orders(t, p, marts)
    ex = t.expenses.groupBy("store_id").agg(F.sum("amount").alias("exp"))
    s = t.stores.select("store_id", "store_name", "city", "state", "region")
    return (
        s.join(so, "store_id", "left")
        .join(ex, "store_id", "left")
        .select(
            "store_id", "store_name", "city", "region",
            F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("total_orders"),
            F.coalesce(F.col("n_customers"), F.lit(0)).cast("long").alias("unique_customers"),
            F.coalesce(F.col("amount"), F.lit(0).cast("decimal(22,2)")).alias("rev"),
            F.coalesce(F.col("exp"), F.lit(0).cast("decimal(22,2)")).alias("exp"),
        )
    )


def store_performance(t: Tables, p: Params = Params(), marts=None, sort: bool = True) -> DataFrame:
    """KPI 11: RANK (gaps) overall and per region, tier from PERCENT_RANK.

    The ascending PERCENT_RANK needs no third ordering: of n stores,
    n - rank - ties + 1 lie below one of descending rank ``rank`` that shares
    its revenue with ``ties`` stores, itself included.

    The global RANK / PERCENT_RANK run through ``rank_window`` (range
    buckets) instead of one single-partition window over all stores; the
    regional rank is bucketed too, so one region holding most stores does
    not become one task.
    """
    ss = store_sales(t, p, marts).withColumn("profit_x", F.col("rev") - F.col("exp"))
    r = rank_windows(
        ss,
        [
            {"order": [desc("rev")], "outputs": {"overall_rank": "rank"}},
            {"order": [desc("rev")], "outputs": {"regional_rank": "rank"},
             "partition_by": ["region"]},
        ],
        tiebreak=["store_id"],
        bucket_rows=p.rank_bucket_rows,
    )
    ties = r.groupBy("rev").agg(F.count(F.lit(1)).alias("_ties"))
    n = ss.select(F.count(F.lit(1))).scalar()
    r = r.join(ties, "rev")
    below = n - F.col("overall_rank") - F.col("_ties") + 1
    r = r.withColumn("prank", F.when(n > 1, below.cast("double") / (n - 1).cast("double")).otherwise(0.0))
    out = r.select(
        "store_id", "store_name", "city", "region", "total_orders", "unique_customers",
        money("rev").alias("revenue"),
        money("exp").alias("expenses"),
        money("profit_x").alias("profit"),
        F.when(F.col("rev") > 0, pct("profit_x", "rev", 1, num_scale=2, den_scale=2))
        .otherwise(F.lit(Decimal("0.0"))).alias("profit_margin_pct"),
        F.when(F.col("total_orders") > 0, div_round("rev", "total_orders", 2, num_scale=2))
        .otherwise(F.lit(Decimal("0.00"))).alias("avg_order_value"),
        "overall_rank",
        "regional_rank",
        tier("prank", p.store_tiers, STORE_TIER_DEFAULT).alias("performance_tier"),
        F.col("rev").alias("_rev"),
    )
    if sort:
        out = out.orderBy(F.col("_rev").desc(), "store_id")
    return out.drop("_rev")


def region_summary(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 12: store_count includes idle stores; NULL revenue without orders.

    Store counts come from the stores dimension alone; the two per-region
    results (a few rows each) are then joined.
    """
    counts = t.stores.groupBy("region").agg(F.count_distinct("store_id").alias("store_count"))
    meas = region_measures(t, p, marts).select(
        "region", F.col("n_orders").alias("total_orders"), F.col("n_customers").alias("unique_customers"),
        F.col("amount").alias("s"), F.col("n_amount").alias("c"))
    # NULL region is a group of its own, as in GROUP BY: null-safe join
    g = counts.join(meas, counts["region"].eqNullSafe(meas["region"]), "left")
    return g.select(
        counts["region"],
        F.col("store_count").cast("long"),
        F.coalesce(F.col("total_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.coalesce(F.col("unique_customers"), F.lit(0)).cast("long").alias("unique_customers"),
        money("s").alias("total_revenue"),
        div_round("s", "c", 2, num_scale=2).alias("avg_order_value"),
        div_round("s", "store_count", 2, num_scale=2).alias("revenue_per_store"),
    ).orderBy(F.col("total_revenue").desc_nulls_first(), "region")
