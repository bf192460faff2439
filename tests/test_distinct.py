"""Mergeable bitmaps: exact distinct counts at every level from one pass."""

import pytest
from pyspark.sql import functions as F

from shopsight.operators.distinct import counted, merged, states
from shopsight.params import FIXTURE_AS_OF, Params
from shopsight.plans import marts, sales, store
from shopsight.plans.marts import Marts
from shopsight.sources.star_schema import tables_from_star
from shopsight.sources.tables import Tables
from tests.conftest import SF001

P = Params(as_of=FIXTURE_AS_OF)
EXTREMES = [0, 1, 63, 64, -1, -64, -65, (1 << 63) - 1, -(1 << 63), 1 << 40]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i % 3, i % 7, (i * i) % 50, i % 11) for i in range(500)]
    data += [(0, 1, x, x) for x in EXTREMES] + [(1, 2, None, 5), (None, 3, 4, None), (9, 9, None, None)]
    return spark.createDataFrame(data, "g int, h int, x long, y long")


def _plain(rows, keys):
    return sorted(map(tuple, rows.groupBy(*keys).agg(
        F.count_distinct("x"), F.count_distinct("y"), F.sum("h"), F.count(F.lit(1))).collect()), key=str)


@pytest.mark.parametrize("keys", [["g", "h"], ["g"], ["h"], []])
def test_levels_equal_count_distinct(rows, keys):
    fine = states(rows, ["g", "h"], {"nx": "x", "ny": "y"}, {"h_sum": F.col("h"), "n": F.lit(1)})
    got = counted(merged(fine, keys, ["h_sum", "n"]), keys, ["nx", "ny"], ["h_sum", "n"])
    assert sorted(map(tuple, got.collect()), key=str) == _plain(rows, keys)


def test_single_count_and_keys_counted_on_merge(rows):
    fine = states(rows, ["g", "h"], {"nx": "x"}, {"n": F.lit(1)})
    got = counted(merged(fine, ["g"], ["n"], also={"nh": "h"}), ["g"], ["nx", "nh"], ["n"])
    want = rows.groupBy("g").agg(F.count_distinct("x"), F.count_distinct("h"), F.count(F.lit(1)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_dense_ids_share_words(spark):
    df = states(spark.range(64_000).select(F.lit(1).alias("g"), "id"), ["g"], {"n": "id"})
    assert df.count() == 1000 and counted(df, ["g"], ["n"], []).first().n == 64_000


def test_only_integers(spark):
    with pytest.raises(TypeError, match="integers"):
        states(spark.createDataFrame([("a",)], "x string"), [], {"n": "x"})


@pytest.fixture(scope="module")
def undeclared(spark):
    """The star tables without the declared key, with repeated and NULL ids."""
    t = tables_from_star(spark, SF001)
    odd = t.orders.orderBy("order_id").limit(40).withColumns({
        "order_id": F.when(F.col("order_id") % 2 == 0, F.col("order_id")),
        "cust_id": F.when(F.col("cust_id") % 3 != 0, F.col("cust_id")),
        "store_id": F.when(F.col("store_id") % 2 == 0, F.col("store_id")).otherwise(-5)})
    kept = {n: t.get(n) for n in ("order_items", "products", "inventory", "stores", "expenses", "customers")}
    again = t.orders.orderBy("order_id").limit(30)
    return Tables(orders=t.orders.unionByName(again).unionByName(odd).cache(), **kept)


JOBS = {"overview": sales.sales_overview, "months": sales.monthly_revenue_trend, "regions": sales.revenue_by_region,
        "region_summary": store.region_summary, "stores": store.store_performance, "rollups": marts.order_rollups}


@pytest.mark.parametrize("name", sorted(JOBS))
def test_from_one_mart_as_alone(spark, undeclared, name):
    """A run's shared states and a job by itself give the same rows, with and
    without a declared key."""
    for t in (tables_from_star(spark, SF001), undeclared):
        shared = Marts(t, P, persist=True)
        try:
            got = sorted(map(tuple, JOBS[name](t, P, marts=shared).collect()), key=str)
            assert got == sorted(map(tuple, JOBS[name](t, P).collect()), key=str) and got
        finally:
            shared.release()


def test_undeclared_keys_are_counted_once(undeclared):
    v = marts.valid_orders(undeclared, P)
    want = v.agg(F.count_distinct("order_id"), F.count_distinct("cust_id"), F.sum("total_amount")).first()
    got = sales.sales_overview(undeclared, P).first()
    assert (got.total_orders, got.total_customers) == (want[0], want[1])
    rolled = {(r.level, r.region, r.store_id, r.month): (r.n_orders, r.n_customers)
              for r in marts.order_rollups(undeclared, P).collect()}
    assert rolled["total", None, None, None] == (want[0], want[1])
    placed = v.join(undeclared.stores, "store_id")
    for r in placed.groupBy("region").agg(F.count_distinct("order_id").alias("o"), F.count_distinct("cust_id").alias("c")).collect():
        assert rolled["region", r.region, None, None] == (r.o, r.c)


def _scans(plan: str, column: str) -> int:
    return sum("FileScan" in x and column in x for x in plan.splitlines())


def test_one_pass_over_orders(spark):
    t = tables_from_star(spark, SF001)
    plan = marts.order_rollups(t, P)._jdf.queryExecution().executedPlan().toString()
    assert _scans(plan, "o_totalprice") == 1


def test_no_shuffle_of_the_few_regions(spark):
    """Orders are shuffled by (store, word), states by (region, word): the rows
    that are keyed by a region alone are its words' counts."""
    t = tables_from_star(spark, SF001)
    plan = sales.revenue_by_region(t, P)._jdf.queryExecution().executedPlan().toString()
    keyed = [x for x in plan.splitlines() if "hashpartitioning(" in x]
    assert "store_id" in keyed[-1] and "word" in keyed[-1]
