"""Customer KPIs 7-10: lifetime value, CLV segments, RFM scores and segments."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from shopsight.functions.semantics import div_round, money, pct, rfm_segment, tier
from shopsight.operators.ranking import asc, desc, rank_windows
from shopsight.params import CLV_DEFAULT, Params
from shopsight.plans.marts import customer_orders
from shopsight.sources.tables import Tables


def _customer_orders(t: Tables, p: Params, marts=None) -> DataFrame:
    return marts.customer_orders() if marts is not None else customer_orders(t, p)


def customer_lifetime_value(t: Tables, p: Params = Params(), marts=None, sort: bool = True) -> DataFrame:
    """KPI 7: every customer, idle ones with 0 / 0 / NULL dates and 'New'.

    Valid orders are aggregated per cust_id first (the status test of the
    LEFT JOIN's ON clause becomes a filter of the right side), then attached
    to customers: one shuffle of orders by cust_id, one of customers.
    """
    co = _customer_orders(t, p, marts)
    c = t.customers.select("cust_id", "full_name", "city", "state", "join_date")
    j = c.join(co, "cust_id", "left")
    out = j.select(
        "cust_id", "full_name", "city", "state", "join_date",
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("long").alias("total_orders"),
        money(F.coalesce(F.col("amount"), F.lit(0))).alias("lifetime_value"),
        F.coalesce(div_round("amount", "n_amount", 2, num_scale=2), F.lit(Decimal("0.00"))).alias(
            "avg_order_value"
        ),
        "first_order",
        "last_order",
        F.col("recency_days").alias("days_since_last_order"),
        tier("amount", p.clv_tiers, CLV_DEFAULT).alias("clv_segment"),
    )
    # ORDER BY lifetime_value DESC: a range-partitioned distributed sort.
    return out.orderBy(F.col("lifetime_value").desc(), "cust_id") if sort else out


def clv_segments(t: Tables, p: Params, marts=None) -> DataFrame:
    """Per segment: count, sum and mean of COALESCEd lifetime value."""
    co = _customer_orders(t, p, marts)
    c = t.customers.select("cust_id")
    lv = c.join(co.select("cust_id", "amount"), "cust_id", "left").select(
        F.coalesce(F.col("amount"), F.lit(0).cast("decimal(22,2)")).alias("lv")
    )
    seg = lv.groupBy(tier("lv", p.clv_tiers, CLV_DEFAULT).alias("segment")).agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("lv").alias("s"),
        F.count("lv").alias("c"),
    )
    return seg


def clv_segment_summary(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 8. The share window runs over at most five segment rows."""
    seg = clv_segments(t, p, marts).withColumn(
        "total", F.sum("customer_count").over(Window.partitionBy())
    )
    return seg.select(
        "segment",
        F.col("customer_count").cast("long"),
        money("s").alias("total_revenue"),
        div_round("s", "c", 2, num_scale=2).alias("avg_clv"),
        pct("customer_count", "total", 1).alias("pct_of_customers"),
    ).orderBy(F.col("avg_clv").desc(), "segment")


def rfm_scores(t: Tables, p: Params, marts=None, with_names: bool = True,
               having_order_id: bool = True) -> DataFrame:
    """Customers with valid orders and their three NTILE scores.

    ``having_order_id``: KPI 9's population (LEFT JOIN ... HAVING
    COUNT(o.order_id) > 0); otherwise KPI 10's (inner JOIN: at least one valid
    order row). They differ only if an order_id can be NULL.

    NTILE over all customers would be one task (``Exchange SinglePartition``);
    ``rank_windows`` computes the same tiles over range buckets. Ties in the
    ORDER BY value are broken by cust_id (the definition leaves them open).
    """
    co = _customer_orders(t, p, marts)
    if having_order_id:
        co = co.filter(F.col("n_order_ids") > 0)
    cols = ["cust_id"] + (["full_name"] if with_names else [])
    base = t.customers.select(*cols).join(co, "cust_id", "inner").select(
        *cols,
        "recency_days",
        F.col("n_orders").cast("long").alias("frequency"),
        F.coalesce(F.col("amount"), F.lit(0).cast("decimal(22,2)")).alias("monetary_exact"),
    )
    k = p.rfm_tiles
    return rank_windows(
        base,
        [
            {"order": [desc("recency_days")], "outputs": {"r_score": ("ntile", k)}},
            {"order": [asc("frequency")], "outputs": {"f_score": ("ntile", k)}},
            {"order": [asc("monetary_exact")], "outputs": {"m_score": ("ntile", k)}},
        ],
        tiebreak=["cust_id"],
        bucket_rows=p.rank_bucket_rows,
    )


def _shared_scores(t: Tables, p: Params, marts) -> DataFrame | None:
    """In a full run with a declared order_id key (unique and non-NULL), KPI
    9's and KPI 10's populations coincide, so the three NTILE passes run once."""
    if marts is None or t.unique_keys.get("orders") != "order_id":
        return None
    return marts.get("rfm_scores", lambda t, p: rfm_scores(t, p, marts))


def rfm_analysis(t: Tables, p: Params = Params(), marts=None, sort: bool = True) -> DataFrame:
    """KPI 9."""
    s = _shared_scores(t, p, marts)
    if s is None:
        s = rfm_scores(t, p, marts)
    out = s.select(
        "cust_id",
        "full_name",
        "recency_days",
        "frequency",
        money("monetary_exact").alias("monetary"),
        "r_score",
        "f_score",
        "m_score",
        F.concat(
            F.col("r_score").cast("string"), F.col("f_score").cast("string"),
            F.col("m_score").cast("string"),
        ).alias("rfm_score"),
        rfm_segment().alias("rfm_segment"),
    )
    return out.orderBy(F.col("monetary").desc(), "cust_id") if sort else out


def rfm_segment_summary(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """KPI 10: per RFM segment; rounding 2 / 2 / 1 / 0 digits."""
    s = _shared_scores(t, p, marts)
    if s is None:
        s = rfm_scores(t, p, marts, with_names=False, having_order_id=False)
    s = s.withColumn("segment", rfm_segment())
    g = s.groupBy("segment").agg(
        F.count(F.lit(1)).alias("customer_count"),
        F.sum("monetary_exact").alias("ms"),
        F.count("monetary_exact").alias("mc"),
        F.sum("frequency").alias("fs"),
        F.count("frequency").alias("fc"),
        F.sum("recency_days").alias("rs"),
        F.count("recency_days").alias("rc"),
    )
    return g.select(
        "segment",
        F.col("customer_count").cast("long"),
        money("ms").alias("total_revenue"),
        div_round("ms", "mc", 2, num_scale=2).alias("avg_value"),
        div_round("fs", "fc", 1).alias("avg_orders"),
        div_round("rs", "rc", 0).alias("avg_recency_days"),
    ).orderBy(F.col("total_revenue").desc(), "segment")
