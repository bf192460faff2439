"""Storage layouts: date-partitioned orders prune; bucketed tables co-locate the order join."""

import os
import tempfile

from shopsight.params import FIXTURE_AS_OF, Params
from shopsight.plans import sales
from shopsight.plans.registry import JOBS
from shopsight.sources.business import (read_catalog_tables, read_parquet_tables,
                                        write_catalog_tables, write_parquet_tables)
from shopsight.sources.star_schema import tables_from_star
from tests.conftest import SF001

P = Params(as_of=FIXTURE_AS_OF)


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_date_partitioned_orders_prune_kpi5(spark):
    root = os.path.join(tempfile.mkdtemp(prefix="shopsight-layout-"), "tables")
    star = tables_from_star(spark, SF001)
    write_parquet_tables(star, root, partition_orders_by_date=True)
    t = read_parquet_tables(spark, root, {"orders": "order_id"})
    df = sales.daily_sales_30d(t, P)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "2001-07-03" in plan
    assert _rows(df) == _rows(sales.daily_sales_30d(star, P))


def test_bucketed_tables_join_without_shuffle(spark):
    loc = tempfile.mkdtemp(prefix="shopsight-wh-")
    star = tables_from_star(spark, SF001)
    write_catalog_tables(star, "shop_bucketed", location=loc, buckets=4)
    t = read_catalog_tables(spark, "shop_bucketed", {"orders": "order_id"})
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = JOBS["top_products"](t, P)
        plan = df._jdf.queryExecution().executedPlan().toString()
        # the order join reads both sides bucketed: no shuffle on order_id
        assert "Exchange hashpartitioning(order_id" not in plan
        assert "SortMergeJoin [order_id" in plan or "ShuffledHashJoin [order_id" in plan  # co-located, not broadcast
        got = _rows(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == _rows(JOBS["top_products"](star, P))


def test_line_join_is_not_forced(spark):
    """Where partitions are large the line join sorts and merges (it can spill)."""
    from shopsight.params import Params
    from shopsight.plans.marts import item_lines
    from shopsight.sources.star_schema import tables_from_star
    from tests.conftest import SF001

    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.autoBroadcastJoinThreshold",
                                           "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")}
    try:
        for k in keep:
            spark.conf.set(k, "-1" if "Broadcast" in k else "0")
        df = item_lines(tables_from_star(spark, SF001), Params(), True)
        n = df.count()
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "ShuffledHashJoin" not in plan
    assert n == item_lines(tables_from_star(spark, SF001), Params(), True).count()
