"""Name -> job registry: every KPI, export payload and catalog metric."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from shopsight.functions.display import with_display
from shopsight.params import DISCOUNTS, ORDER_STATUSES, Params
from shopsight.operators import quality
from shopsight.plans import catalog, customer, exports, governance, product, sales, store
from shopsight.plans.marts import order_rollups
from shopsight.sources.tables import Tables

KPIS: dict[str, Callable[..., DataFrame]] = {  # 1-14
    "sales_overview": sales.sales_overview,
    "monthly_revenue_trend": sales.monthly_revenue_trend,
    "revenue_by_category": sales.revenue_by_category,
    "revenue_by_region": sales.revenue_by_region,
    "daily_sales_30d": sales.daily_sales_30d,
    "top_products": sales.top_products,
    "customer_lifetime_value": customer.customer_lifetime_value,
    "clv_segment_summary": customer.clv_segment_summary,
    "rfm_analysis": customer.rfm_analysis,
    "rfm_segment_summary": customer.rfm_segment_summary,
    "store_performance": store.store_performance,
    "region_summary": store.region_summary,
    "product_performance": product.product_performance,
    "category_performance": product.category_performance,
}

JOBS: dict[str, Callable[[Tables, Params], DataFrame]] = {
    **KPIS,
    # every level of the order counts from one pass over the orders
    "order_rollups": order_rollups,
    # export payloads
    "export_sales_overview": exports.export_sales_overview,
    "export_monthly_trends": exports.export_monthly_trends,
    "export_category_sales": exports.export_category_sales,
    "export_customer_segments": exports.export_customer_segments,
    "export_store_performance": exports.export_store_performance,
    "export_top_products": exports.export_top_products,
    # metric catalog
    **{k: (lambda f: (lambda t, p: f(t)))(f) for k, f in catalog.METRICS.items()},
    "metric_mart": lambda t, p: catalog.metric_mart(t),
    "metric_mart_incremental": governance.incremental_mart,
    "metric_catalog": lambda t, p: catalog.metric_catalog(t),
    # the export documents, with a fixed stamp
    **{f"document_{name}": (lambda fn, bounded, single: lambda t, p: exports.stamped(fn(t, p), bounded, single))(
        fn, bounded, name in exports.SINGLE_OBJECT) for name, (fn, bounded) in exports.EXPORTS.items()},
    # serving tables with the dashboard's display columns
    "display_store_performance": lambda t, p: with_display("store_performance", store.store_performance(t, p)),
    "display_product_performance": lambda t, p: with_display("product_performance", product.product_performance(t, p)),
    "display_top_products": lambda t, p: with_display("top_products", sales.top_products(t, p)),
    "display_export_stores": lambda t, p: with_display("export_store_performance", exports.export_store_performance(t, p)),
    "display_export_products": lambda t, p: with_display("export_top_products", exports.export_top_products(t, p)),
    # data-quality reports over the business tables
    "quality_key_report": lambda t, p: quality.key_report(t),
    "quality_domain_report": lambda t, p: quality.domain(t.orders, "orders", "order_status", ORDER_STATUSES).unionByName(
        quality.domain(t.order_items, "order_items", "discount", DISCOUNTS)),
    "quality_length_report": lambda t, p: governance.length_report(t, p, {k: JOBS[k] for k in LOGGED}),
    # what the sinks and the logs of a run hold
    "run_audit": lambda t, p: governance.logged_run(t, p, {k: JOBS[k] for k in LOGGED}).select(
        "kpi_name", "rows_returned", "status", "error_message"),
    "refresh_audit": governance.refresh_audit,
    "published_kpis": lambda t, p: governance.published_kpis(t, p, KPIS),
    "published_customer_values": lambda t, p: governance.read_back(
        t, p, "customer_lifetime_value", customer.customer_lifetime_value),
}

#: Jobs whose log rows ``run_audit`` shows.
LOGGED = ("sales_overview", "region_summary", "export_customer_segments")
