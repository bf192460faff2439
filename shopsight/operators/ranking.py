"""Distributed RANK / PERCENT_RANK / ROW_NUMBER / NTILE.

Spark plans a window without PARTITION BY (or with a hot partition key) as
one task over all rows (``Exchange SinglePartition``). The KPIs rank
entity-grain rows — every customer, store or product — so that task would
grow with the data. This operator computes the same numbers with the work
spread over range buckets:

1. The ORDER BY list becomes one ascending, null-free struct key (a NULL flag
   per column, negated values for DESC) plus a unique tie-break.
2. Rows whose ``xxhash64(key)`` falls under a fixed threshold form a sample
   (~``oversample`` rows per ``bucket_rows`` rows). Every ``stride``-th sample
   key per group becomes a bucket boundary; ``stride`` grows with the total
   sample so the boundary set never exceeds ``MAX_BOUNDS`` keys. The
   boundaries are therefore a pure function of the data (stable when a lost
   task is recomputed) and small by construction, which is what makes the
   broadcast below safe.
3. bucket = number of boundaries <= key (binary search: 16 halving steps folded
   in one aggregate() expression).
4. ROW_NUMBER / RANK inside (group, bucket) with an ordinary window; bucket
   row counts give offsets via a window over the small bucket table.
5. Equal ORDER BY values can straddle buckets; for RANK the first row of each
   tie is found from per-bucket (min, max) candidates.

Hot groups are cut into buckets of at most ~max(bucket_rows, N/MAX_BOUNDS)
rows; groups smaller than a bucket stay whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from shopsight.operators import selection

MAX_BOUNDS = 65535  # boundary keys over all groups; binary search needs 16 steps
_SEARCH_STEPS = [1 << i for i in range(15, -1, -1)]
_HASH_SPACE = 1 << 40


@dataclass(frozen=True)
class Order:
    """One ORDER BY item. ``nulls_first`` defaults to PostgreSQL's rule
    (NULLS LAST for ASC, NULLS FIRST for DESC)."""

    column: str
    ascending: bool = True
    nulls_first: bool | None = None

    def nulls_first_resolved(self) -> bool:
        return (not self.ascending) if self.nulls_first is None else self.nulls_first


def asc(c: str, nulls_first: bool | None = None) -> Order:
    return Order(c, True, nulls_first)


def desc(c: str, nulls_first: bool | None = None) -> Order:
    return Order(c, False, nulls_first)


_INTEGERS = ("byte", "short", "integer", "long")
_FLOATS = ("float", "double")


def _check_types(df: DataFrame, order: list[Order]) -> None:
    """The same inputs are accepted whatever the number of rows."""
    for o in order:
        dtype = df.schema[o.column].dataType.typeName()
        known = (*_INTEGERS, *_FLOATS, "decimal", "date", "timestamp", "timestamp_ntz", "boolean")
        if dtype not in known and not (dtype == "string" and o.ascending):
            way = "ascending" if o.ascending else "descending"
            raise TypeError(f"{way} order on {dtype} column {o.column!r} is not supported")


def _ascending_value(df: DataFrame, o: Order) -> Column:
    """A value that sorts upwards; NaN, which has a flag of its own, is 0."""
    c = F.col(o.column)
    dtype = df.schema[o.column].dataType.typeName()
    if dtype == "date":
        c = F.unix_date(c)
    elif dtype.startswith("timestamp"):
        c = F.unix_micros(c.cast("timestamp")) if dtype == "timestamp_ntz" else F.unix_micros(c)
    elif dtype == "boolean":
        c = c.cast("int")
    elif dtype in _FLOATS:
        c = F.when(F.isnan(c), F.lit(0.0)).otherwise(c.cast("double")) + F.lit(0.0)  # -0.0 is 0.0
    if not o.ascending:
        # the smallest LONG has no negative as a LONG
        c = -(c.cast("decimal(20,0)") if dtype in (*_INTEGERS, "timestamp", "timestamp_ntz") else c)
    return c


def _zero_for(df: DataFrame, o: Order) -> Column:
    return F.lit("") if df.schema[o.column].dataType.typeName() == "string" else F.lit(0)


def _key_fields(df: DataFrame, order: list[Order]) -> list[Column]:
    fields = []
    for i, o in enumerate(order):
        isnull = F.col(o.column).isNull()
        # flag 0 sorts first
        flag = F.when(isnull, 0 if o.nulls_first_resolved() else 1).otherwise(
            1 if o.nulls_first_resolved() else 0
        )
        if df.schema[o.column].dataType.typeName() in _FLOATS:
            # as in Spark's own order: NaN is larger than any number
            nan = F.when(F.isnan(F.col(o.column)), 1 if o.ascending else -1).otherwise(0)
            flag = 3 * flag + F.coalesce(nan, F.lit(0))
        val = F.coalesce(_ascending_value(df, o), _zero_for(df, o))
        fields += [flag.alias(f"n{i}"), val.alias(f"v{i}")]
    return fields


def rank_window(
    df: DataFrame,
    order: list[Order],
    tiebreak: list[str],
    outputs: dict[str, str | tuple],
    partition_by: list[str] | tuple = (),
    bucket_rows: int = 2_000_000,
    oversample: int = 20,
    max_bounds: int = MAX_BOUNDS,
    materialize: bool = True,
    _skip_small_check: bool = False,
    _input_materialized: bool = False,
) -> DataFrame:
    """Add ranking columns computed over ``partition_by`` / ``order``.

    ``outputs`` maps new column names to ``"rank"``, ``"percent_rank"``,
    ``"row_number"`` or ``("ntile", k)``. RANK and PERCENT_RANK see ties on
    ``order`` only; ROW_NUMBER and NTILE break ties with ``tiebreak``, which
    must make rows unique within a group (the engine-defined order of the
    built-in functions is replaced by this explicit one). Output types are
    BIGINT, except PERCENT_RANK (DOUBLE).

    The input is read three times (sample, boundaries, numbering); with
    ``materialize`` it is first written as a Parquet table under the shared
    ``spark.checkpoint.dir`` (``session.materialize``), so its lineage is
    computed once and a lost executor does not send the recomputation back
    to the sources.
    """
    if not tiebreak:
        raise ValueError("a unique tie-break column list is required")
    _check_types(df, order)
    if bucket_rows > _HASH_SPACE * oversample:
        raise ValueError(f"bucket_rows is at most {_HASH_SPACE * oversample}: the sample can't be thinner")
    max_bounds = min(max_bounds, MAX_BOUNDS)
    parts = list(partition_by)
    if materialize and not _input_materialized:
        df = _materialize(df)
    if materialize and not _skip_small_check:
        # Exact size check on the materialized input: when every row fits in
        # one bucket, the bucketed plan would produce a single bucket anyway,
        # and Spark's own window over <= bucket_rows rows is the same work
        # with fewer jobs.
        n_rows = df.count()
        if n_rows <= bucket_rows:
            return _builtin_window(df, order, tiebreak, outputs, parts)
        if n_rows > 2 * max_bounds * bucket_rows:
            raise ValueError(f"{n_rows} rows don't fit {max_bounds} buckets of {bucket_rows}: raise bucket_rows")
    tie_fields = _key_fields(df, order)
    tb_fields = [F.col(t).alias(f"t{i}") for i, t in enumerate(tiebreak)]
    cols = {"_key": F.struct(*tie_fields, *tb_fields), "_tie": F.struct(*tie_fields)}
    if parts:
        # One non-null group key; struct equality treats NULL fields as equal,
        # so plain equi-joins on it keep GROUP BY's NULL-group semantics and
        # line up with the hash partitioning of the windows.
        cols["_grp"] = F.struct(*parts)
    base = df.withColumns(cols)
    grp = ["_grp"] if parts else []

    # --- 2. deterministic sample -> boundary keys --------------------------
    rate = min(1.0, oversample / max(bucket_rows, 1))
    threshold = int(round(rate * _HASH_SPACE))
    sample = base.filter(F.pmod(F.xxhash64("_key"), F.lit(_HASH_SPACE)) < threshold).select(
        *grp, "_key"
    )
    total_sample = sample.select(F.count(F.lit(1))).scalar()
    stride = F.greatest(
        F.lit(oversample).cast("long"),
        F.ceil(total_sample / F.lit(float(max_bounds))).cast("long"),
    )
    if parts:
        w_sample = Window.partitionBy("_grp").orderBy("_key")
        cut = sample.withColumn("_srn", F.row_number().over(w_sample)).filter(
            F.col("_srn") % stride == 0
        )
        bounds = cut.groupBy("_grp").agg(F.sort_array(F.collect_list("_key")).alias("_bounds"))
        # At most max_bounds keys in total (one per ``stride`` sample rows), so
        # the broadcast is bounded regardless of the input size.
        with_bounds = base.join(F.broadcast(bounds), "_grp", "left")
    else:
        # One group: the sample is ordered by a distributed sort (range
        # partitioned) and numbered with a prefix over its partitions; the
        # boundary array comes back as a scalar subquery of <= max_bounds keys.
        numbered_sample = _global_row_number(sample.select("_key"), "_key", "_srn")
        arr = (
            numbered_sample.filter(F.col("_srn") % stride == 0)
            .select(F.sort_array(F.collect_list("_key")).alias("b"))
            .scalar()
        )
        with_bounds = base.withColumn("_bounds", arr)

    # --- 3. bucket = #boundaries <= key (binary search) --------------------
    # One higher-order expression folding over the 16 step sizes: O(log B)
    # comparisons per row. (Chained withColumn steps would be collapsed by
    # the optimizer into one expression that grows 3x per step.)
    b = F.col("_bounds")
    size = F.coalesce(F.size(b), F.lit(0))
    key = F.col("_key")

    def step(pos, inc):
        cand = pos + inc
        return F.when((cand <= size) & (F.try_element_at(b, cand) <= key), cand).otherwise(pos)

    steps = F.array(*[F.lit(s) for s in _SEARCH_STEPS])
    with_bucket = with_bounds.withColumn("_bucket", F.aggregate(steps, F.lit(0), step)).drop(
        "_bounds"
    )

    # --- 4. numbering inside buckets ----------------------------------------
    # The only row-level shuffle: hash partitioning on (group, bucket).
    group_cols = [*grp, "_bucket"]
    n_tie = len(tie_fields)
    tie_order = [F.col("_key")[f"n{i // 2}" if i % 2 == 0 else f"v{i // 2}"] for i in range(n_tie)]
    full_order = tie_order + [F.col("_key")[f"t{i}"] for i in range(len(tiebreak))]
    w_full = Window.partitionBy(*group_cols).orderBy(*full_order)
    w_tie = Window.partitionBy(*group_cols).orderBy(*tie_order)
    kinds = {v if isinstance(v, str) else v[0] for v in outputs.values()}
    need_rank = bool(kinds & {"rank", "percent_rank"})
    need_rn = bool(kinds & {"row_number", "ntile"})
    numbered = with_bucket
    if need_rn:
        numbered = numbered.withColumn("_rn", F.row_number().over(w_full).cast("long"))
    if need_rank:
        numbered = numbered.withColumn("_rk", F.rank().over(w_tie).cast("long"))
    if materialize:
        # Computed once (scan, bucket search, shuffle, windows) and kept for
        # the bucket table and the final join; a lost block is recomputed
        # from the materialized input with the same (deterministic) buckets.
        from shopsight.session import persist_derived

        numbered = persist_derived(numbered)

    # bucket table: counts, offsets, group sizes (one row per bucket)
    aggs = [F.count(F.lit(1)).alias("_cnt")]
    if need_rank:
        aggs += [F.min("_tie").alias("_min_tie"), F.max("_tie").alias("_max_tie"),
                 F.max("_rk").alias("_max_rk")]
    stats = numbered.groupBy(*group_cols).agg(*aggs)
    # Windows over the bucket table: one row per bucket (<= max_bounds + groups).
    w_grp = Window.partitionBy(*grp).orderBy("_bucket")
    stats = stats.withColumns(
        {
            "_offset": F.coalesce(
                F.sum("_cnt").over(w_grp.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).cast("long"),
            "_n": F.sum("_cnt").over(Window.partitionBy(*grp)).cast("long"),
        }
    )
    if materialize:
        # small (one row per bucket) but read three times below
        from shopsight.session import persist_derived

        stats = persist_derived(stats)
    if need_rank:
        cands = stats.select(
            *grp, F.col("_min_tie").alias("_tv"), (F.col("_offset") + 1).alias("_first")
        ).unionByName(
            stats.select(
                *grp,
                F.col("_max_tie").alias("_tv"),
                (F.col("_offset") + F.col("_max_rk")).alias("_first"),
            )
        )
        firsts = cands.groupBy(*grp, "_tv").agg(F.min("_first").alias("_min_first"))
        firsts = firsts.withColumnRenamed("_tv", "_min_tie")
        stats = stats.join(firsts, [*grp, "_min_tie"], "left")
    keep = [*group_cols, "_offset", "_n"] + (["_min_tie", "_min_first"] if need_rank else [])
    stats = stats.select(*keep).withColumnsRenamed(
        {"_min_tie": "_bucket_min_tie"} if need_rank else {}
    )
    joined = numbered.join(stats, group_cols, "inner")

    # --- 5. final numbers -----------------------------------------------------
    g = (F.col("_offset") + F.col("_rn")) if need_rn else None
    n = F.col("_n")
    rank = None
    if need_rank:
        rank = F.when(F.col("_tie") == F.col("_bucket_min_tie"), F.col("_min_first")).otherwise(
            F.col("_offset") + F.col("_rk")
        )
    cols = {}
    for name, kind in outputs.items():
        k = kind if isinstance(kind, str) else kind[0]
        if k == "row_number":
            cols[name] = g
        elif k == "rank":
            cols[name] = rank
        elif k == "percent_rank":
            cols[name] = F.when(n > 1, (rank - 1).cast("double") / (n - 1).cast("double")).otherwise(
                F.lit(0.0)
            )
        elif k == "ntile":
            cols[name] = ntile_of(g, n, int(kind[1]))
        else:
            raise ValueError(f"unknown ranking kind {kind!r}")
    out = joined.withColumns(cols)
    return out.drop("_key", "_tie", "_grp", "_bucket", "_rn", "_rk", "_offset", "_n",
                    "_bucket_min_tie", "_min_first")


def rank_windows(
    df: DataFrame,
    specs: list[dict],
    tiebreak: list[str],
    bucket_rows: int = 2_000_000,
    **kw,
) -> DataFrame:
    """Several rankings of the same rows, e.g. three NTILEs with different
    orderings. ``specs`` items: ``{"order": [...], "outputs": {...},
    "partition_by": [...]}``.

    The input is materialized and counted once. When it fits one bucket all
    windows run directly. Beyond that, tiles (NTILE over all rows) are found by
    selection, for all orderings together and without a shuffle of rows
    (``operators/selection.py``); other specs run the bucketed path in turn
    (each ordering needs its own buckets). Each step's output is written
    (``materialize``) before the next step starts: otherwise every later
    step's plan would contain all earlier steps with their subqueries, and
    planning time would grow with the number of orderings.
    """
    for spec in specs:
        _check_types(df, spec["order"])
    df = _materialize(df)
    if df.count() <= bucket_rows:
        for spec in specs:
            df = _builtin_window(df, spec["order"], tiebreak, spec["outputs"],
                                 list(spec.get("partition_by", ())))
        return df
    if _only_tiles(df, specs, tiebreak):
        return _selected_tiles(df, specs, tiebreak)
    for i, spec in enumerate(specs):
        if i:
            df = _materialize(df)
        df = rank_window(df, spec["order"], tiebreak, spec["outputs"],
                         partition_by=spec.get("partition_by", ()), bucket_rows=bucket_rows,
                         materialize=True, _skip_small_check=True,
                         _input_materialized=True, **kw)
    return df


def _only_tiles(df: DataFrame, specs: list[dict], tiebreak: list[str]) -> bool:
    kinds = [k for spec in specs for k in spec["outputs"].values()]
    columns = [*tiebreak, *(o.column for spec in specs for o in spec["order"])]
    return all(not isinstance(k, str) and k[0] == "ntile" and k[1] <= selection.MAX_TILES for k in kinds) and not any(
        spec.get("partition_by") for spec in specs) and selection.fits(df, columns)


def _selected_tiles(df: DataFrame, specs: list[dict], tiebreak: list[str]) -> DataFrame:
    """``df`` (materialized) with its tiles. NULL tie-breaks come first, as in
    the ascending order of the windows."""
    keys: dict[str, Column] = {}
    orderings, counts = [], []
    for i, spec in enumerate(specs):
        fields = _key_fields(df, [*spec["order"], *(asc(t, nulls_first=True) for t in tiebreak)])
        names = [f"__key{i}_{j}" for j in range(len(fields))]
        keys |= {n: selection.integer_key(df, f, n) for n, f in zip(names, fields)}
        for name, kind in spec["outputs"].items():
            orderings.append((name, names))
            counts.append(int(kind[1]))
    keyed = df.withColumns(keys)
    n = df.count()
    found = selection.ends(keyed, [names for _, names in orderings], [selection.tile_ends(n, k) for k in counts])
    tiles = {name: sum((selection.after(names, key).cast("long") for key in cuts), F.lit(1).cast("long"))
             for (name, names), cuts in zip(orderings, found)}
    return keyed.withColumns(tiles).drop(*keys)


def _spark_order(o: Order) -> Column:
    c = F.col(o.column)
    if o.ascending:
        return c.asc_nulls_first() if o.nulls_first_resolved() else c.asc_nulls_last()
    return c.desc_nulls_first() if o.nulls_first_resolved() else c.desc_nulls_last()


def _builtin_window(df: DataFrame, order: list[Order], tiebreak: list[str],
                    outputs: dict, parts: list[str]) -> DataFrame:
    """Same numbers with Spark's window functions (used for inputs of at most
    one bucket, so a partition holds no more than ``bucket_rows`` rows)."""
    by = [_spark_order(o) for o in order]
    w = Window.partitionBy(*parts).orderBy(*by) if parts else Window.orderBy(*by)
    by_t = by + [F.col(t).asc() for t in tiebreak]
    wt = Window.partitionBy(*parts).orderBy(*by_t) if parts else Window.orderBy(*by_t)
    cols = {}
    for name, kind in outputs.items():
        k = kind if isinstance(kind, str) else kind[0]
        if k == "row_number":
            cols[name] = F.row_number().over(wt).cast("long")
        elif k == "rank":
            cols[name] = F.rank().over(w).cast("long")
        elif k == "percent_rank":
            cols[name] = F.percent_rank().over(w)
        elif k == "ntile":
            cols[name] = F.ntile(int(kind[1])).over(wt).cast("long")
        else:
            raise ValueError(f"unknown ranking kind {kind!r}")
    return df.withColumns(cols)


def _materialize(df: DataFrame) -> DataFrame:
    from shopsight.session import materialize

    return materialize(df)


def ntile_of(g: Column, n: Column, k: int) -> Column:
    """NTILE(k) of the g-th of n rows: the first n % k tiles hold one extra row."""
    base = F.call_function("div", n, F.lit(k))
    rem = n % k
    thr = rem * (base + 1)
    first = F.call_function("div", g + base, base + 1)  # ceil(g / (base+1))
    rest = rem + F.call_function("div", g - thr + base - 1, F.greatest(base, F.lit(1)))
    return F.when(g <= thr, first).otherwise(rest).cast("long")


def _global_row_number(df: DataFrame, key: str, out: str) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY key) for a modest frame (the sample) without
    a single-partition window: range-partitioned sort, per-partition counts,
    and a prefix over the partition ids."""
    ranged = df.repartitionByRange(key).sortWithinPartitions(key)
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    local = ranged.withColumn(
        "_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(key)).cast("long")
    )
    counts = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_pc"))
    offsets = counts.withColumn(
        "_po",
        F.coalesce(
            F.sum("_pc").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_pid", "_po")
    # one row per shuffle partition: bounded by spark.sql.shuffle.partitions
    return local.join(F.broadcast(offsets), "_pid").select(
        key, (F.col("_po") + F.col("_lrn")).alias(out)
    )
