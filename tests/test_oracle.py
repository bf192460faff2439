"""Every registered query equals its DuckDB oracle SQL (sf0.001: fast)."""

import pytest

import __spark_entry__ as E
from scripts.check_oracle import duck_connect, rows_of
from tests.conftest import SF001

from oracle.sql import ORACLE
from shopsight.plans.registry import JOBS

NAMES = sorted(JOBS)


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF001)


def test_every_query_has_oracle_sql():
    assert set(JOBS) <= set(E.oracle_sql()) and set(JOBS) <= set(E.queries())
    assert set(ORACLE) == set(JOBS)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    srows = [r.asDict() for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drecs = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert sorted(sdf.columns) == sorted(dcols)
    cols = sorted(dcols)
    assert rows_of(cols, srows) == rows_of(cols, drecs)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "performance_tier" in df.columns


RANKED = ["rfm_analysis", "rfm_segment_summary", "store_performance",
          "product_performance", "export_store_performance"]


@pytest.mark.parametrize("name", RANKED)
def test_bucketed_ranking_matches_oracle(spark, duck, name):
    """The ranking KPIs with tiny range buckets (the distributed path that
    large inputs take) still equal the oracle's built-in window functions."""
    from dataclasses import replace

    from shopsight.plans.registry import JOBS
    from shopsight.sources.star_schema import tables_from_star

    params = replace(E.PARAMS, rank_bucket_rows=9)
    sdf = JOBS[name](tables_from_star(spark, SF001), params)
    srows = [r.asDict() for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drecs = [dict(zip(dcols, r)) for r in res.fetchall()]
    cols = sorted(dcols)
    assert rows_of(cols, srows) == rows_of(cols, drecs)
