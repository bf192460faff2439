"""Edge cases on hand-made tables (the reference ships no data or tests)."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shopsight.params import Params
from shopsight.plans import customer, exports, product, sales, store
from shopsight.sources.tables import SCHEMAS, Tables

AS_OF = dt.date(2024, 3, 31)
P = Params(as_of=AS_OF)


def make(spark, **rows):
    frames = {}
    for name, schema in SCHEMAS.items():
        frames[name] = spark.createDataFrame(rows.get(name, []), schema)
    return Tables(**frames, unique_keys={"orders": "order_id"})


STORES = [(1, "S1", "C1", "ST1", "EAST"), (2, "S2", "C2", "ST2", "EAST"), (3, "Idle", "C3", "ST3", "WEST")]
CUSTOMERS = [(10, "Ann", "C1", "ST1", dt.date(2020, 1, 1)), (11, "Bob", "C2", "ST2", dt.date(2020, 1, 2)),
             (12, "Idle", "C3", "ST3", dt.date(2020, 1, 3))]
PRODUCTS = [(100, "bolt", "HW", "B1", D("5.00")), (101, "nut", "HW", "B2", D("1.00")),
            (102, "unsold", "TOY", "B3", D("9.99"))]
ORDERS = [
    (1, 10, 1, dt.date(2024, 1, 5), "Delivered", D("100.00")),
    (2, 10, 1, dt.date(2024, 3, 20), "Shipped", D("50.25")),
    (3, 11, 2, dt.date(2024, 3, 21), "Cancelled", D("999.00")),
    (4, 11, 2, dt.date(2024, 3, 30), None, D("7.00")),            # NULL status: excluded
    (5, 11, 2, dt.date(2024, 3, 2), "Processing", D("600.00")),
]
ITEMS = [
    (1, 100, 2, D("10.00"), None),          # NULL discount = 0
    (1, 101, 1, D("3.00"), D("10.00")),
    (2, 100, 1, D("10.00"), D("50.00")),
    (3, 100, 5, D("10.00"), None),          # cancelled order: counts in KPI 13/14 only
    (5, 101, 4, D("3.00"), None),
]


@pytest.fixture(scope="module")
def t(spark):
    return make(spark, stores=STORES, customers=CUSTOMERS, products=PRODUCTS, orders=ORDERS,
                order_items=ITEMS, inventory=[(100, 1, 5), (100, 2, 5), (101, 1, 0)],
                expenses=[(1, D("20.00")), (1, D("5.00")), (2, D("1000.00"))])


def test_empty_orders_give_one_row(spark):
    e = make(spark)
    r = sales.sales_overview(e, P).collect()
    assert len(r) == 1
    assert r[0]["total_revenue"] is None and r[0]["total_orders"] == 0
    assert r[0]["total_customers"] == 0 and r[0]["avg_order_value"] is None


def test_sales_overview_filters_status(spark, t):
    r = sales.sales_overview(t, P).first()
    assert r["total_orders"] == 3 and r["total_customers"] == 2
    assert r["total_revenue"] == D("750.25")
    assert r["avg_order_value"] == D("250.08")  # 750.25 / 3 = 250.0833
    assert r["revenue_per_customer"] == D("375.13")  # 375.125 rounds half up


def test_monthly_lag_skips_missing_month(spark, t):
    rows = sales.monthly_revenue_trend(t, P).collect()
    assert [r["month_label"] for r in rows] == ["Jan 2024", "Mar 2024"]
    assert rows[0]["mom_growth_pct"] is None
    assert rows[1]["mom_growth_pct"] == D("550.3")  # (650.25 - 100) / 100 * 100


def test_daily_window_counts_rows_not_days(spark, t):
    rows = sales.daily_sales_30d(t, P).collect()
    assert [r["sale_date"] for r in rows] == [dt.date(2024, 3, 2), dt.date(2024, 3, 20)]
    assert rows[0]["day_name"] == "Sat"
    assert rows[1]["moving_avg_7d"] == D("325.13")  # (600 + 50.25) / 2


def test_clv_keeps_idle_customers(spark, t):
    rows = {r["cust_id"]: r for r in customer.customer_lifetime_value(t, P).collect()}
    idle = rows[12]
    assert idle["total_orders"] == 0 and idle["lifetime_value"] == D("0.0")
    assert idle["avg_order_value"] == D("0.0") and idle["first_order"] is None
    assert idle["days_since_last_order"] is None and idle["clv_segment"] == "New"
    assert rows[11]["clv_segment"] == "Bronze" and rows[11]["days_since_last_order"] == 29


def test_rfm_with_fewer_customers_than_tiles(spark, t):
    rows = {r["cust_id"]: r for r in customer.rfm_analysis(t, P).collect()}
    assert set(rows) == {10, 11}           # idle customer has no valid order
    assert rows[10]["r_score"] == 2 and rows[11]["r_score"] == 1
    assert rows[10]["rfm_score"] == f"{rows[10]['r_score']}{rows[10]['f_score']}{rows[10]['m_score']}"


def test_product_performance_counts_all_status_lines(spark, t):
    rows = {r["prod_id"]: r for r in product.product_performance(t, P).collect()}
    bolt = rows[100]
    assert bolt["units_sold"] == 8            # includes the cancelled order's 5
    assert bolt["order_count"] == 2           # orders 1 and 2 only
    assert bolt["revenue"] == D("75.0")            # 20 + 5 + 50
    assert rows[102]["units_sold"] == 0 and rows[102]["stores_stocked"] is None
    assert rows[102]["stock_status"] == "Out of Stock" and rows[101]["stock_status"] == "Out of Stock"
    assert bolt["stock_status"] == "In Stock" and bolt["stores_stocked"] == 2
    assert rows[102]["category_rank"] == 1    # NULL revenue ranks last; alone in TOY
    cat = {r["category"]: r for r in sales.revenue_by_category(t, P).collect()}
    assert cat["HW"]["units_sold"] == 3 + 5  # KPI 3: bolt 2+1, nut 1+4; cancelled line excluded
    kpi14 = {r["category"]: r for r in product.category_performance(t, P).collect()}
    assert kpi14["HW"]["total_units_sold"] == 3 + 5 + 5  # KPI 14 keeps the cancelled line


def test_category_performance_keeps_unsold(spark, t):
    rows = {r["category"]: r for r in product.category_performance(t, P).collect()}
    assert rows["TOY"]["product_count"] == 1 and rows["TOY"]["revenue"] is None
    assert rows["TOY"]["order_count"] == 0 and rows["TOY"]["pct_of_revenue"] is None
    assert rows["HW"]["pct_of_revenue"] == D("100.0")


def test_store_performance_and_idle_store(spark, t):
    rows = {r["store_id"]: r for r in store.store_performance(t, P).collect()}
    assert rows[3]["revenue"] == D("0.0") and rows[3]["profit_margin_pct"] == D("0.0")
    assert rows[3]["avg_order_value"] == D("0.0") and rows[3]["overall_rank"] == 3
    assert rows[2]["profit_margin_pct"] == D("-66.7")  # (600 - 1000) / 600
    assert rows[1]["regional_rank"] == 2 and rows[2]["regional_rank"] == 1
    assert rows[2]["performance_tier"] == "Star" and rows[3]["performance_tier"] == "Needs Attention"


def test_export_store_performance_idle_store_is_star(spark, t):
    rows = {r["store_name"]: r for r in exports.export_store_performance(t, P).collect()}
    assert rows["Idle"]["revenue"] is None and rows["Idle"]["orders"] == 0
    assert rows["Idle"]["performance_tier"] == "Star"


def test_region_summary_counts_idle_stores(spark, t):
    rows = {r["region"]: r for r in store.region_summary(t, P).collect()}
    assert rows["WEST"]["store_count"] == 1 and rows["WEST"]["total_revenue"] is None
    assert rows["WEST"]["total_orders"] == 0
    by4 = {r["region"]: r for r in sales.revenue_by_region(t, P).collect()}
    assert "WEST" not in by4 and by4["EAST"]["store_count"] == 2


def test_one_store_percent_rank_zero(spark):
    one = make(spark, stores=[(1, "S", "C", "S", "R")],
               orders=[(1, 1, 1, dt.date(2024, 1, 1), "Delivered", D("5.00"))])
    r = store.store_performance(one, P).first()
    assert r["overall_rank"] == 1 and r["performance_tier"] == "Needs Attention"


def test_json_document_shape(spark, t):
    import json
    doc = exports.document(exports.export_monthly_trends(t, P), single=False,
                           generated_at=F.lit(dt.datetime(2024, 4, 1, 12, 0))).first()["json"]
    parsed = json.loads(doc)
    assert parsed["generated_at"].startswith("2024-04-01T12:00")
    assert [d["month"] for d in parsed["data"]] == ["Jan 2024", "Mar 2024"]
    single = json.loads(exports.document(exports.export_sales_overview(t, P), single=True).first()["json"])
    assert set(single["data"]) == {"total_revenue", "total_orders", "total_customers", "avg_order_value"}
    empty = make(spark)
    e = json.loads(exports.document(exports.export_monthly_trends(empty, P), single=False).first()["json"])
    assert e["data"] is None  # json_agg over no rows is NULL, and the key is kept


def test_json_numbers_print_like_rounded_numerics(spark, t):
    doc = exports.document(exports.export_category_sales(t, P), single=False,
                           generated_at=F.lit(dt.datetime(2024, 4, 1))).first()["json"]
    # HW gross over valid lines: bolt 2*10 + 1*10, nut 1*3 + 4*3
    assert '"category":"HW","revenue":45.00,"units_sold":8,"pct_of_total":100.0' in doc
    assert "E1" not in doc and "E+" not in doc
    one = exports.document(exports.export_sales_overview(t, P), single=True).first()["json"]
    assert '"total_revenue":750.25' in one and '"avg_order_value":250.08' in one


def test_null_amount_and_repeated_product_in_order(spark):
    t2 = make(
        spark,
        stores=STORES, customers=CUSTOMERS, products=PRODUCTS,
        orders=[(1, 10, 1, dt.date(2024, 1, 5), "Delivered", D("100.00")),
                (2, 11, 1, dt.date(2024, 1, 6), "Delivered", None)],   # NULL amount
        order_items=[(1, 100, 1, D("10.00"), None), (1, 100, 2, D("10.00"), None),
                     (2, 100, 1, D("10.00"), None)],
    )
    r = sales.sales_overview(t2, P).first()
    assert r["total_orders"] == 2 and r["total_customers"] == 2
    assert r["avg_order_value"] == D("100.0")        # AVG skips the NULL amount
    assert r["revenue_per_customer"] == D("50.0")    # SUM / COUNT(DISTINCT cust_id)
    top = {x["prod_id"]: x for x in sales.top_products(t2, P).collect()}
    assert top[100]["order_count"] == 2 and top[100]["units_sold"] == 4
    clv = {x["cust_id"]: x for x in customer.customer_lifetime_value(t2, P).collect()}
    assert clv[11]["total_orders"] == 1 and clv[11]["lifetime_value"] == D("0.0")
    assert clv[11]["avg_order_value"] == D("0.0") and clv[11]["clv_segment"] == "New"


def test_orders_without_a_date_come_last(spark):
    """The growth of the first dated month must not refer to undated orders."""
    import datetime as dt
    from decimal import Decimal

    from shopsight.plans.sales import monthly_revenue_trend
    from shopsight.sources.tables import SCHEMAS, Tables

    rows = [(1, 1, 1, None, "Shipped", Decimal("5.00")),
            (2, 1, 1, dt.date(2020, 1, 3), "Shipped", Decimal("10.00")),
            (3, 1, 1, dt.date(2020, 2, 3), "Shipped", Decimal("20.00"))]
    t = Tables(**{n: spark.createDataFrame(rows if n == "orders" else [], SCHEMAS[n]) for n in SCHEMAS})
    got = [(r.month_label, r.mom_growth_pct) for r in monthly_revenue_trend(t).collect()]
    assert got == [("Jan 2020", None), ("Feb 2020", D("100.0")), (None, D("-75.0"))]


def test_every_source_row_is_mapped(spark):
    from shopsight.sources.star_schema import tables_from_star
    from tests.conftest import SF001

    t = tables_from_star(spark, SF001)
    n = lambda name: spark.read.parquet(f"{SF001}/{name}.parquet").count()
    assert t.order_items.count() == n("lineitem")
    assert t.expenses.count() == n("supplier")
    assert t.inventory.count() >= n("part")
    sold = t.order_items.select("prod_id").distinct()
    assert t.products.join(sold, "prod_id", "left_anti").count() > 0
