"""Data-quality checks as DataFrame jobs.

Each check returns rows ``(check, table, columns, violations)`` so the
checks of a run union into one report table. All are single distributed
aggregations (partial aggregation map-side); nothing is collected except the
final counts.

* ``unique``   — keys that occur more than once (``groupBy(key).count() > 1``)
* ``not_null`` — NULLs per required column, all columns in one pass (``count_if``)
* ``length``   — strings longer than their column allows
* ``domain``   — values outside an allowed set (NULL counts as outside)
* ``orphans``  — child rows whose key has no parent row

``keys_report`` makes the checks of all keys in one pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, functions as F

from shopsight.sources.tables import DIMENSION_KEYS, Tables


def _row(df: DataFrame, check: str, table: str, columns: str, n) -> DataFrame:
    return df.select(
        F.lit(check).alias("check"), F.lit(table).alias("table"),
        F.lit(columns).alias("columns"), n.cast("long").alias("violations"),
    )


def unique(df: DataFrame, table: str, *keys: str) -> DataFrame:
    """Number of key values that occur more than once."""
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1)
    return _row(dup.agg(F.count(F.lit(1)).alias("n")), "unique", table, ",".join(keys), F.col("n"))


def _report(agg: DataFrame, table: str, names: list[tuple[str, str]]) -> DataFrame:
    """Report rows of one aggregate row, whose columns are named check:columns."""
    rows = [F.struct(F.lit(c).alias("check"), F.lit(table).alias("table"), F.lit(k).alias("columns"),
                     F.coalesce(F.col(f"`{c}:{k}`"), F.lit(0)).cast("long").alias("violations")) for c, k in names]
    return agg.select(F.inline(F.array(*rows)))


@dataclass(frozen=True)
class Key:
    """A key column, the table that it identifies, and the tables that refer to it."""

    column: str
    parent: str
    children: tuple[str, ...]


def keys_report(t: Tables, keys: list[Key], unique_parents: set[str]) -> DataFrame:
    """Repeated parent keys, NULL keys and orphans of all ``keys`` in one pass.

    Every table is scanned once: a row gives one narrow row for each key in it,
    which says whether the row is the key's parent or a child. They meet in one
    aggregation by key, where both sides' counts stand beside each other; it
    combines map-side, so a hot key costs a row a task and lines are not
    shuffled one by one.
    """
    sides: dict[str, list[tuple[Key, str]]] = {}
    for k in keys:
        for table in (k.parent, *k.children):
            sides.setdefault(table, []).append((k, table))
    rows = None
    for table, own in sides.items():
        each = [F.struct(F.lit(k.column).alias("kind"), F.col(k.column).cast("long").alias("key"),
                         *(F.lit(1 if table == side else 0).cast("long").alias(f"in_{side}")
                           for side in dict.fromkeys(s for x in keys for s in (x.parent, *x.children))))
                for k, _ in own]
        flat = t.get(table).select(F.inline(F.array(*each)))
        rows = flat if rows is None else rows.unionByName(flat)
    tables = [c for c in rows.columns if c.startswith("in_")]
    per_key = rows.groupBy("kind", "key").agg(*(F.sum(c).alias(c) for c in tables))
    checks, aggs = [], []
    for k in keys:
        mine, parent = F.col("kind") == k.column, F.col(f"in_{k.parent}")
        if k.parent in unique_parents:
            checks.append(("unique", k.parent, k.column))
            aggs.append(F.count_if(mine & (parent > 1)))
        for side in k.children:
            n = F.col(f"in_{side}")
            checks += [("not_null", side, k.column), ("orphans", side, k.column)]
            aggs += [F.sum(F.when(mine & F.col("key").isNull(), n)),
                     F.sum(F.when(mine & F.col("key").isNotNull() & (parent == 0), n))]
        checks.append(("not_null", k.parent, k.column))
        aggs.append(F.sum(F.when(mine & F.col("key").isNull(), parent)))
    one = per_key.agg(*(F.coalesce(a, F.lit(0)).cast("long").alias(f"n{i}") for i, a in enumerate(aggs)))
    out = [F.struct(F.lit(c).alias("check"), F.lit(tbl).alias("table"), F.lit(col).alias("columns"),
                    F.col(f"n{i}").alias("violations")) for i, (c, tbl, col) in enumerate(checks)]
    return one.select(F.inline(F.array(*out)))


def not_null(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """NULL counts of all ``columns`` in one scan, unpivoted to one report row each."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in columns])
    long = agg.unpivot([], list(columns), "columns", "violations")
    return long.select(
        F.lit("not_null").alias("check"), F.lit(table).alias("table"),
        "columns", F.col("violations").cast("long").alias("violations"),
    )


def max_length(df: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """Values with more characters than their column takes (VARCHAR(n)), in one scan."""
    agg = df.agg(*(F.count_if(F.char_length(c) > n).alias(f"length:{c}") for c, n in limits.items()))
    return _report(agg, table, [("length", c) for c in limits])


def domain(df: DataFrame, table: str, column: str, allowed) -> DataFrame:
    bad = F.count_if(~F.coalesce(F.col(column).isin(*allowed), F.lit(False)))
    return _row(df.agg(bad.alias("n")), "domain", table, column, F.col("n"))


#: The keys by which the tables' rows meet.
KEYS = [Key("order_id", "orders", ("order_items",)), Key("prod_id", "products", ("order_items",)),
        Key("store_id", "stores", ("orders",)), Key("cust_id", "customers", ("orders",))]


def key_report(t: Tables) -> DataFrame:
    """Checks that make the pre-aggregated plans exact: unique dimension keys
    (and declared unique keys), non-NULL join keys, and orphan facts."""
    declared = dict(t.unique_keys)
    checked = set(DIMENSION_KEYS)
    if declared.get("orders") == "order_id":
        checked.add("orders")
        del declared["orders"]
    out = keys_report(t, KEYS, checked)
    # a dimension's own NULL keys are repeats or rows that nothing meets
    out = out.where(~((F.col("check") == "not_null") & F.col("table").isin(*DIMENSION_KEYS)))
    for tbl, key in declared.items():
        out = out.unionByName(unique(t.get(tbl), tbl, key)).unionByName(not_null(t.get(tbl), tbl, key))
    return out


@dataclass(frozen=True)
class RowCheck:
    """Something that no row of a table should be; a ``strict`` one stops a run."""

    check: str
    column: str
    violated: Callable[[], Column]
    strict: bool = True


def null_check(column: str, strict: bool = True) -> RowCheck:
    return RowCheck("not_null", column, lambda: F.col(column).isNull(), strict)


def domain_check(column: str, allowed, strict: bool = True) -> RowCheck:
    return RowCheck("domain", column, lambda: ~F.coalesce(F.col(column).isin(*allowed), F.lit(False)), strict)


_EVENTS_MS = 600_000  # a large cluster's events may take a while


class Watch:
    """Row checks that ride on a scan which a run makes anyway: the counts come
    with the scan's own job (``DataFrame.observe``), no job is run for them."""

    def __init__(self) -> None:
        self._seen: dict[str, tuple[Observation, list[RowCheck]]] = {}
        self._bus = None

    def on(self, df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
        """``df``, whose next full scan is checked; a table is watched once."""
        if table in self._seen:
            return df
        obs = Observation(f"{table}_{uuid.uuid4().hex}")
        self._seen[table] = (obs, checks)
        self._bus = df.sparkSession.sparkContext._jsc.sc().listenerBus()
        return df.observe(obs, *(F.count_if(c.violated()).alias(f"n{i}") for i, c in enumerate(checks)))

    def report(self) -> list[tuple[str, str, str, int]]:
        """(check, table, columns, violations) of the scans that have run."""
        rows = []
        if self._bus is not None:
            self._bus.waitUntilEmpty(_EVENTS_MS)  # the counts of finished jobs come as events
        for table, (obs, checks) in self._seen.items():
            if obs._jo.future().isCompleted():  # get would wait for a scan that is still to come
                found = obs.get
                rows += [(c.check, table, c.column, int(found[f"n{i}"])) for i, c in enumerate(checks)]
        return rows

    def assert_clean(self) -> None:
        """Raise if a strict check has violations in the scans so far."""
        strict = {(c.check, table, c.column) for table, (_, checks) in self._seen.items() for c in checks if c.strict}
        bad = [r for r in self.report() if r[3] and r[:3] in strict]
        if bad:
            raise ValueError("data quality violations: " + "; ".join(f"{c} {t}.{k}={n}" for c, t, k, n in bad))


def assert_clean(report: DataFrame, checks=("unique",)) -> None:
    """Raise if any listed check has violations (collects the small report)."""
    bad = report.filter(F.col("check").isin(*checks) & (F.col("violations") > 0)).collect()
    if bad:
        raise ValueError("data quality violations: " + "; ".join(
            f"{r['check']} {r['table']}.{r['columns']}={r['violations']}" for r in bad))


def assert_keys(report: DataFrame, t: Tables) -> None:
    """Raise if a declared key has NULLs: it would not identify its rows."""
    declared = [f"{tbl}.{key}" for tbl, key in t.unique_keys.items()]
    bad = report.filter((F.col("check") == "not_null") & (F.col("violations") > 0)
                        & F.concat_ws(".", "table", "columns").isin(*declared)).collect()
    if bad:
        raise ValueError("NULL in declared keys: " + "; ".join(
            f"{r['table']}.{r['columns']}={r['violations']}" for r in bad))
