"""rank_window equals Spark's built-in window functions (with explicit ties)."""

import pytest
from pyspark.sql import Window, functions as F

from shopsight.operators.ranking import asc, desc, rank_window


def _frame(spark, n=600, mod=23, hot_share=3):
    # v: many ties, NULLs, one value holding a third of the rows; g: a hot group
    return spark.range(n).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 17 == 0, F.lit(None))
        .when(F.col("id") % hot_share == 0, F.lit(5))
        .otherwise(F.col("id") % mod).cast("long").alias("v"),
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise((F.col("id") % 4).cast("string")).alias("g"),
        (F.col("id") * 7 % 101).cast("decimal(12,2)").alias("d"),
    )


def _builtin(df, order_cols, parts, tiebreak):
    w = Window.partitionBy(*parts).orderBy(*order_cols) if parts else Window.orderBy(*order_cols)
    wt = w.orderBy(*order_cols, *tiebreak) if not parts else Window.partitionBy(*parts).orderBy(*order_cols, *tiebreak)
    return df.select(
        "k",
        F.rank().over(w).cast("long").alias("rk"),
        F.percent_rank().over(w).alias("pr"),
        F.row_number().over(wt).cast("long").alias("rn"),
        F.ntile(5).over(wt).cast("long").alias("nt"),
    )


@pytest.mark.parametrize("bucket_rows", [7, 40, 10_000, 100_000_000])
@pytest.mark.parametrize("parts", [[], ["g"]])
@pytest.mark.parametrize("direction", ["desc", "asc"])
def test_matches_builtin(spark, bucket_rows, parts, direction):
    df = _frame(spark)
    if direction == "desc":
        order, cols = [desc("v")], [F.col("v").desc_nulls_first()]
    else:
        order, cols = [asc("v")], [F.col("v").asc_nulls_last()]
    got = rank_window(
        df, order, tiebreak=["k"], partition_by=parts, bucket_rows=bucket_rows,
        outputs={"rk": "rank", "pr": "percent_rank", "rn": "row_number", "nt": ("ntile", 5)},
    ).select("k", "rk", "pr", "rn", "nt")
    want = _builtin(df, cols, parts, [F.col("k")])
    a = sorted(tuple(r) for r in got.collect())
    b = sorted(tuple(r) for r in want.collect())
    assert len(a) == df.count()
    assert a == b


def test_decimal_and_explicit_nulls_last(spark):
    df = _frame(spark, n=300)
    got = rank_window(df, [desc("d", nulls_first=False)], tiebreak=["k"],
                      outputs={"rk": "rank"}, bucket_rows=11).select("k", "rk")
    want = df.select("k", F.rank().over(Window.orderBy(F.col("d").desc_nulls_last())).cast("long").alias("rk"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("n", [0, 1, 2, 4, 5, 6, 9, 59])
def test_ntile_small_counts(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"))
    got = rank_window(df, [asc("v")], tiebreak=["k"], outputs={"nt": ("ntile", 5)}, bucket_rows=2)
    want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")).cast("long").alias("nt"))
    assert sorted(map(tuple, got.select("k", "nt").collect())) == sorted(map(tuple, want.collect()))


def test_ntile_sizes_differ_by_at_most_one(spark):
    df = spark.range(1003).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    got = rank_window(df, [asc("v")], tiebreak=["k"], outputs={"nt": ("ntile", 5)}, bucket_rows=30)
    sizes = [r["count"] for r in got.groupBy("nt").count().collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_no_single_partition_window_over_rows(spark):
    """The numbering windows are partitioned; only bucket-grain tables
    (one row per bucket) may pass through a single partition."""
    df = _frame(spark)
    out = rank_window(df, [desc("v")], tiebreak=["k"], outputs={"rk": "rank"}, bucket_rows=40)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # windows over the rows are partitioned by the bucket
    assert "_bucket" in plan


@pytest.mark.parametrize("bucket_rows", [13, 10_000])
def test_rank_windows_several_orderings(spark, bucket_rows):
    from shopsight.operators.ranking import rank_windows

    df = _frame(spark, n=400)
    got = rank_windows(
        df,
        [{"order": [desc("v")], "outputs": {"a": "rank"}},
         {"order": [asc("d")], "outputs": {"b": ("ntile", 5)}, "partition_by": ["g"]},
         {"order": [asc("v")], "outputs": {"c": "percent_rank"}}],
        tiebreak=["k"], bucket_rows=bucket_rows,
    ).select("k", "a", "b", "c")
    want = df.select(
        "k",
        F.rank().over(Window.orderBy(F.col("v").desc_nulls_first())).cast("long").alias("a"),
        F.ntile(5).over(Window.partitionBy("g").orderBy(F.col("d").asc_nulls_last(), "k")).cast("long").alias("b"),
        F.percent_rank().over(Window.orderBy(F.col("v").asc_nulls_last())).alias("c"),
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_same_types_and_answers_on_both_sides_of_the_limit(spark):
    """NaN, the smallest LONG, booleans and timestamps rank alike with Spark's
    window and with range buckets; unsupported types fail on both."""
    import datetime as dt

    import pytest

    from shopsight.operators.ranking import asc, desc, rank_window

    rows = [(i, v, n, i % 2 == 0, dt.datetime(2020, 1, 1 + i % 3), f"s{i % 4}") for i, (v, n) in enumerate(
        [(1.0, 5), (float("nan"), -(2**63)), (None, None), (-0.0, 2**63 - 1), (0.0, 5), (float("inf"), 0),
         (float("nan"), 5), (float("-inf"), -1)])]
    df = spark.createDataFrame(rows, "k long, v double, n long, b boolean, t timestamp, s string")
    for order in ([asc("v")], [desc("v")], [desc("n")], [asc("n")], [desc("b")], [desc("t")], [asc("s")]):
        answers = []
        for limit in (1000, 2):
            got = rank_window(df, order, ["k"], {"r": "rank", "i": "row_number"}, bucket_rows=limit)
            answers.append(sorted((x.k, x.r, x.i) for x in got.collect()))
        assert answers[0] == answers[1], order
    for limit in (1000, 2):
        with pytest.raises(TypeError):
            rank_window(df, [desc("s")], ["k"], {"r": "rank"}, bucket_rows=limit)
