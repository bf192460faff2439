"""NTILE by selection equals the built-in, without a shuffle of rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from shopsight.operators import selection
from shopsight.operators.ranking import asc, desc, rank_windows


def _builtin(df, specs, tiebreak):
    for order, name, k in specs:
        by = [(F.col(o.column).asc_nulls_first() if o.nulls_first_resolved() else F.col(o.column).asc_nulls_last())
              if o.ascending else
              (F.col(o.column).desc_nulls_first() if o.nulls_first_resolved() else F.col(o.column).desc_nulls_last())
              for o in order]
        df = df.withColumn(name, F.ntile(k).over(Window.orderBy(*by, *tiebreak)).cast("long"))
    return sorted(map(tuple, df.collect()), key=str)


def _selected(df, specs, tiebreak):
    # a bucket of no rows: never the built-in window
    out = rank_windows(df, [{"order": o, "outputs": {n: ("ntile", k)}} for o, n, k in specs], tiebreak, bucket_rows=0)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    return sorted(map(tuple, out.collect()), key=str)


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(3)
    data = [(i, r.choice([5, 5, 5, 5, 7, None, -3]), Decimal(r.randrange(-10**9, 10**9)) / 100, r.choice([True, False, None]),
             dt.date(2000, 1, 1) + dt.timedelta(r.randrange(2000)), r.randrange(-2**63, 2**63)) for i in range(1003)]
    data += [(2000 + i, 5, Decimal("99999999999999999999.99") * (-1) ** i, None, None, None) for i in range(4)]
    return spark.createDataFrame(data, "k long, v int, m decimal(22,2), b boolean, d date, w long").cache()


SPECS = {
    "rfm": [([desc("v")], "r", 5), ([asc("v")], "f", 5), ([asc("m")], "s", 5)],
    "wide": [([asc("w")], "a", 7), ([desc("w")], "z", 4), ([desc("m")], "s", 100)],
    "several": [([asc("b"), desc("d"), asc("v", nulls_first=True)], "x", 10), ([desc("b", nulls_first=False)], "y", 3)],
    "one": [([asc("d")], "x", 1)],
    "more tiles than rows": [([asc("v")], "x", 20)],
}


@pytest.mark.parametrize("name", SPECS)
@pytest.mark.parametrize("cells", [100, 8192])
def test_equals_ntile(rows, name, cells, monkeypatch):
    if name == "more tiles than rows":
        rows = rows.where("k < 9")
    monkeypatch.setattr(selection, "CELLS", cells)
    assert _selected(rows, SPECS[name], ["k"]) == _builtin(rows, SPECS[name], ["k"])


def test_ties_at_every_end(spark):
    """All rows have one value: the ends lie in the tie-break alone."""
    df = spark.range(1000, 2234).select(F.col("id").alias("k"), F.lit(4).alias("v"), (F.col("id") % 2).alias("u"))
    specs = [([desc("v")], "x", 5), ([asc("u")], "y", 8)]
    assert _selected(df, specs, ["k"]) == _builtin(df, specs, ["k"])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-4, 4), st.integers(-2**63, 2**63 - 1)), min_size=1, max_size=40), st.integers(1, 9))
def test_any_values(spark, values, k):
    df = spark.createDataFrame(list(enumerate(values)), "k int, v long")
    specs = [([asc("v")], "x", k), ([desc("v")], "y", k)]
    assert _selected(df, specs, ["k"]) == _builtin(df, specs, ["k"])


def test_other_types_take_the_buckets(spark):
    df = spark.createDataFrame([(i, float(i % 7), str(i % 5)) for i in range(60)], "k int, v double, s string")
    for order in ([asc("v")], [asc("s")]):
        out = rank_windows(df, [{"order": order, "outputs": {"x": ("ntile", 4)}}], ["k"], bucket_rows=7)
        assert sorted(map(tuple, out.collect()), key=str) == _builtin(df, [(order, "x", 4)], ["k"])


def test_a_pass_shuffles_counts_only(spark):
    """Whatever the number of rows, the driver takes CELLS counts an end."""
    df = spark.range(50_000).select(((F.col("id") * 7919) % 1_000_003).alias("k"))
    (keys,) = selection.ends(df, [["k"]], [[1, 10_000, 25_000, 50_000]])
    want = sorted((i * 7919) % 1_000_003 for i in range(50_000))
    assert [k for (k,) in keys] == [want[0], want[9_999], want[24_999], want[49_999]]
