"""Time the distributed ranking against Spark's single-task window.

usage: python scripts/bench_ranking.py [rows] [bucket_rows]

Operator benchmark on generated rows (id, value with ~1000 distinct values,
so heavy ties): RANK over value DESC and NTILE(5) over value ASC, once with
``rank_windows`` (range buckets) and once with built-in windows without
PARTITION BY (one task). Prints both times and whether the results agree.
"""

from __future__ import annotations

import os
import sys
import time

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, HERE)


def main(argv: list[str]) -> None:
    from pyspark.sql import Window, functions as F

    from shopsight.operators.ranking import asc, desc, rank_windows
    from shopsight.session import build_session, materialize

    n = int(argv[1]) if len(argv) > 1 else 20_000_000
    bucket_rows = int(argv[2]) if len(argv) > 2 else 2_000_000
    spark = build_session("local[8]", app="rank-bench", shuffle_partitions=32)
    spark.sparkContext.setLogLevel("ERROR")
    df = materialize(spark.range(n).select(F.col("id").alias("k"),
                                           (F.xxhash64("id") % 1000).alias("v")))
    t0 = time.perf_counter()
    got = rank_windows(
        df,
        [{"order": [desc("v")], "outputs": {"rk": "rank"}},
         {"order": [asc("v")], "outputs": {"nt": ("ntile", 5)}}],
        tiebreak=["k"], bucket_rows=bucket_rows,
    ).agg(F.sum("rk"), F.sum("nt"), F.count("*")).first()
    t1 = time.perf_counter()
    want = df.select(
        F.rank().over(Window.orderBy(F.col("v").desc())).alias("rk"),
        F.ntile(5).over(Window.orderBy("v", "k")).alias("nt"),
    ).agg(F.sum("rk"), F.sum("nt"), F.count("*")).first()
    t2 = time.perf_counter()
    print(f"rows={n} bucketed={t1 - t0:.1f}s single_task={t2 - t1:.1f}s equal={tuple(got) == tuple(want)}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
