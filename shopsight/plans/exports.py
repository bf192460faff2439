"""Dashboard export payloads and their JSON documents.

Each ``export_*`` function returns the payload rows (one row per array
element; one row for the single-object export). ``document`` wraps payload
rows into the ``{generated_at, data}`` document the dashboard reads; the
row content differs from the KPI of similar name and both are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopsight.functions.semantics import div_round, money, tier
from shopsight.operators.ranking import asc, rank_window
from shopsight.params import STORE_TIER_DEFAULT, Params
from shopsight.plans import customer as customer_kpis
from shopsight.plans import sales as sales_kpis
from shopsight.plans.marts import store_orders
from shopsight.sources.tables import Tables


def export_sales_overview(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """Export 1: KPI 1 without revenue per customer (a single JSON object)."""
    return sales_kpis.sales_overview(t, p, marts).drop("revenue_per_customer")


def export_monthly_trends(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """Export 2: one object per month with sales, ordered by month.

    As written, the definition nests SUM inside json_agg and groups a scalar
    subquery, which PostgreSQL rejects; this is its evident intent.
    """
    m = sales_kpis.monthly_data(t, p, marts)
    return m.select(
        F.date_format("month_date", "MMM yyyy").alias("month"),
        money("rev").alias("revenue"),
        F.col("orders").cast("long").alias("orders"),
        F.col("month_date").alias("_order"),
    ).orderBy(F.col("_order").asc_nulls_last()).drop("_order")


def export_category_sales(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """Export 3: like KPI 3 but GROSS revenue (discount ignored), no order count."""
    return sales_kpis.revenue_by_category(t, p, measure="gross", marts=marts).drop("order_count")


def export_customer_segments(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """Export 4: KPI 8 without the percentage."""
    seg = customer_kpis.clv_segments(t, p, marts)
    return seg.select(
        "segment",
        F.col("customer_count").cast("long"),
        money("s").alias("total_revenue"),
        div_round("s", "c", 2, num_scale=2).alias("avg_clv"),
    ).orderBy(F.col("total_revenue").desc(), "segment")


def export_store_performance(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """Export 5: three tiers; COUNT(order_id) (not distinct); NULL revenue for
    idle stores, which sort last ascending and so rank near the top: idle
    stores get a high PERCENT_RANK, hence 'Star'. The NULL placement is
    stated explicitly to keep that behaviour."""
    so = store_orders(t, p, marts)
    s = t.stores.select("store_id", "store_name", "city", "region")
    j = s.join(so.select("store_id", "amount", "n_order_rows"), "store_id", "left")
    r = rank_window(
        j, [asc("amount", nulls_first=False)], outputs={"pr": "percent_rank"},
        tiebreak=["store_id"], bucket_rows=p.rank_bucket_rows,
    )
    return r.select(
        "store_name", "city", "region",
        money("amount").alias("revenue"),
        F.coalesce(F.col("n_order_rows"), F.lit(0)).cast("long").alias("orders"),
        tier("pr", p.export_store_tiers, STORE_TIER_DEFAULT).alias("performance_tier"),
        F.col("amount").alias("_a"), F.col("store_id").alias("_s"),
    ).orderBy(F.col("_a").desc_nulls_first(), "_s").drop("_a", "_s")


def export_top_products(t: Tables, p: Params = Params(), marts=None) -> DataFrame:
    """Export 6: top n by GROSS revenue, fields renamed for the dashboard."""
    ps = sales_kpis.product_revenue(t, p, measure="gross", marts=marts)
    top = ps.select(
        "prod_id", money("value").alias("revenue"), F.col("units").cast("long").alias("units_sold")
    ).orderBy(F.col("revenue").desc_nulls_first(), "prod_id").limit(p.top_n)
    names = t.products.select("prod_id", F.col("prod_name").alias("product_name"), "category", "brand")
    return (
        top.join(names, "prod_id", "inner")
        .orderBy(F.col("revenue").desc_nulls_first(), "prod_id")
        .select("product_name", "category", "brand", "revenue", "units_sold")
    )


# name: (payload function, bounded). Bounded payloads (one row, months, segments,
# top n) become one {generated_at, data} document. Payloads with an element per
# store or category grow with the data: their documents are written in parts
# (``document_lines``) instead of as one array value built in a single task.
EXPORTS = {
    "sales_overview": (export_sales_overview, True),
    "monthly_trends": (export_monthly_trends, True),
    "category_sales": (export_category_sales, False),
    "customer_segments": (export_customer_segments, True),
    "store_performance": (export_store_performance, False),
    "top_products": (export_top_products, True),
}
SINGLE_OBJECT = {"sales_overview"}
# Rounded numbers print with the scale their ROUND gives (11534588112.51, 17.6),
# not as doubles (1.153458811251E10): double fields are cast to DECIMAL with
# this scale in the documents (default 2: money). Payload rows stay DOUBLE.
JSON_SCALES = {"pct_of_total": 1}


def _json_fields(payload: DataFrame) -> list[Column]:
    out = []
    for f in payload.schema.fields:
        if f.dataType.typeName() == "double":
            scale = JSON_SCALES.get(f.name, 2)
            out.append(F.col(f.name).cast(f"decimal(38,{scale})").alias(f.name))
        else:
            out.append(F.col(f.name))
    return out


def document_lines(payload: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """A per-entity document as lines: a head, one element a line in the
    payload's order, a foot. Joined, they are ``{generated_at, data: [...]}``
    (``data: null`` for no rows). Elements are written where the payload's sort
    left them; nothing is gathered."""
    ts = generated_at if generated_at is not None else F.current_timestamp()
    spark = payload.sparkSession
    element = F.to_json(F.struct(*_json_fields(payload)), {"ignoreNullFields": "false"})
    # the range-partitioned sort leaves the first element at the first place
    first = F.monotonically_increasing_id() == 0
    body = payload.select(F.concat(F.when(first, "[").otherwise(","), element).alias("line"))
    one = spark.range(1, numPartitions=1)
    stamp = F.get_json_object(F.to_json(F.struct(ts.alias("t"))), "$.t")
    head = one.select(F.concat(F.lit('{"generated_at":"'), stamp, F.lit('","data":')).alias("line"))
    # an empty payload has no element that opens the array
    some = payload.select(F.count(F.lit(1)) > 0).scalar()
    foot = one.select(F.when(some, "]}").otherwise("null}").alias("line"))
    return head.union(body).union(foot)


def stamped(payload: DataFrame, bounded: bool, single: bool, at: str = "2001-08-02T00:00:00.000Z") -> DataFrame:
    """An export's document with a fixed ``generated_at``."""
    stamp = F.lit(at)
    return document(payload, single, stamp) if bounded else document_lines(payload, stamp)


def document(payload: DataFrame, single: bool, generated_at: Column | None = None,
             order_by: list[Column] | None = None) -> DataFrame:
    """One-row DataFrame with column ``json``: ``{"generated_at": ..., "data": ...}``.

    For payloads that are bounded by their definitions (1 row, months, segments,
    top n); the document is a single value by nature. Array
    order is made explicit: rows are numbered before aggregation and the
    array is sorted by that number (collect_list alone does not keep order
    across partitions). An empty array becomes JSON null, like json_agg.
    Null fields are kept (``ignoreNullFields=false``).
    """
    ts = generated_at if generated_at is not None else F.current_timestamp()
    fields = _json_fields(payload)
    if single:
        data = payload.select(F.struct(*fields).alias("data"))
        agg = data.agg(F.first("data").alias("data"))
    else:
        if order_by is None:
            # keep the payload's own ORDER BY: number rows in that order
            numbered = payload.withColumn("_seq", F.monotonically_increasing_id())
        else:
            numbered = payload.orderBy(*order_by).withColumn("_seq", F.monotonically_increasing_id())
        items = numbered.select(F.struct(F.col("_seq"), F.struct(*fields).alias("v")).alias("e"))
        agg = items.agg(F.sort_array(F.collect_list("e")).alias("arr")).select(
            F.when(F.size("arr") > 0, F.transform("arr", lambda e: e["v"])).alias("data")
        )
    doc = agg.select(F.struct(ts.alias("generated_at"), F.col("data")).alias("doc"))
    return doc.select(F.to_json("doc", {"ignoreNullFields": "false"}).alias("json"))
