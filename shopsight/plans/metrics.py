"""Metrics from registry rows: one scan a table, states that can be kept.

A row of the registry says what a metric is: a table, a measure (``sum`` of a
column, ``distinct`` values of one, ``ratio`` of a sum and a count), a filter, and
the entity that it is given for. All metrics of a table come from one scan: each
source row gives one narrow row a metric, and these are added up per metric and
entity as mergeable states (``operators/distinct.py``): a sum, a count, words of
a bitmap. A new row is a new metric, without new code.

States of files are kept apart by file. ``update`` asks the log which files are
counted, reads the others and adds their states; ``current`` merges the states
of the files that are there now. A file that was replaced or removed drops out
by its size and time, a replayed update finds its rows and adds none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from shopsight import published
from shopsight.functions.semantics import div_round
from shopsight.operators.distinct import bit, word
from shopsight.sources.tables import SCHEMAS, Tables

#: Every metric's value: money and counts exactly, a ratio to 6 decimals.
VALUE = "decimal(38,6)"
#: What is added up: money and integers, in a type that generated code holds as a LONG.
_ADDED = "decimal(18,2)"
KINDS = ("sum", "distinct", "ratio")


@dataclass(frozen=True)
class Metric:
    """A registry row. ``column`` is summed or counted; a ratio divides by the
    number of non-NULL values of ``per``; ``entity`` is (type, column)."""

    name: str
    category: str
    description: str
    formula: str
    sources: str
    table: str
    kind: str
    column: str
    per: str | None = None
    where: str | None = None
    entity: tuple[str, str] | None = None

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"{self.name}: a measure is one of {KINDS}, not {self.kind!r}")
        if (self.kind == "ratio") != (self.per is not None):
            raise ValueError(f"{self.name}: a ratio, and nothing else, has a column to divide by")
        if self.table not in SCHEMAS:
            raise ValueError(f"{self.name}: there is no table {self.table!r}")


def from_rows(rows: Iterable[Row]) -> list[Metric]:
    """Metrics of registry rows, such as those of a table: kpi_name,
    kpi_category, description, formula, source_tables, table_name, measure,
    column_name, per_column, row_filter, entity_type, entity_column."""
    return [Metric(r.kpi_name, r.kpi_category, r.description, r.formula, r.source_tables, r.table_name, r.measure,
                   r.column_name, r.per_column, r.row_filter, (r.entity_type, r.entity_column) if r.entity_type else None)
            for r in rows]


def _is_key(unique_keys: dict, m: Metric) -> bool:
    return unique_keys.get(m.table) == m.column


def states(rows: DataFrame, metrics: list[Metric], unique_keys: dict | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, metric, entity_id, word, bits, total, n) of the rows of one table."""
    unique = unique_keys or {}
    types = {f.name: f.dataType for f in rows.schema.fields}
    each = []
    for m in metrics:
        c = F.col(m.column)
        kept = F.expr(m.where) if m.where else F.lit(True)
        added, counted = F.lit(None).cast(_ADDED), F.lit(0)
        wide, bits = F.lit(None).cast("long"), F.lit(None).cast("long")
        if m.kind == "distinct" and not _is_key(unique, m):
            wide, bits = word(c), bit(c)
        elif m.kind == "distinct":
            counted = F.when(c.isNotNull(), 1).otherwise(0)
        else:
            kind = types[m.column]
            if kind.typeName() == "decimal" and (kind.scale > 2 or kind.precision - kind.scale > 16):
                raise TypeError(f"{m.name}: {m.column} is {kind.simpleString()}, sums take {_ADDED}")
            added = c.cast(_ADDED)
            if m.per:
                counted = F.when(F.col(m.per).isNotNull(), 1).otherwise(0)
        entity = F.col(m.entity[1]).cast("long") if m.entity else F.lit(None).cast("long")
        each.append(F.when(kept, F.struct(
            F.lit(m.name).alias("metric"), entity.alias("entity_id"), wide.alias("word"), bits.alias("bits"),
            added.alias("total"), counted.cast("long").alias("n"))))
    flat = rows.select(*by, F.explode(F.array(*each)).alias("x")).where(F.col("x").isNotNull()).select(*by, "x.*")
    return merged(flat, by)


def merged(df: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    return df.groupBy(*by, "metric", "entity_id", "word").agg(
        F.bit_or("bits").alias("bits"), F.sum("total").cast("decimal(28,2)").alias("total"), F.sum("n").alias("n"))


def values(df: DataFrame, metrics: list[Metric], unique_keys: dict | None = None) -> DataFrame:
    """(metric, entity_type, entity_id, value) of merged states. A metric without
    an entity has its row on empty tables, too."""
    unique = unique_keys or {}
    spark = df.sparkSession
    whole = [m.name for m in metrics if not m.entity]
    if whole:
        nothing = spark.range(1, numPartitions=1).select(F.explode(F.array(*map(F.lit, whole))).alias("metric")).select(
            "metric", *(F.lit(None).cast(df.schema[c].dataType).alias(c) for c in ("entity_id", "word", "bits", "total")),
            F.lit(0).cast("long").alias("n"))
        df = df.select(*nothing.columns).unionByName(nothing)
    sums = df.groupBy("metric", "entity_id").agg(
        F.sum("total").cast("decimal(38,2)").alias("total"), F.sum("n").alias("n"),
        F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).alias("ids"))
    value, kind = None, None
    for m in metrics:
        v = F.col("total") if m.kind == "sum" else div_round("total", "n", 6, num_scale=2) if m.kind == "ratio" else F.col(
            "n" if _is_key(unique, m) else "ids")
        mine, etype = F.col("metric") == m.name, F.lit(m.entity[0] if m.entity else "all")
        value = F.when(mine, v.cast(VALUE)) if value is None else value.when(mine, v.cast(VALUE))
        kind = F.when(mine, etype) if kind is None else kind.when(mine, etype)
    return sums.select("metric", kind.alias("entity_type"), "entity_id", value.alias("value"))


def mart(t: Tables, metrics: list[Metric]) -> DataFrame:
    """All metrics of the tables as they are: one scan a table."""
    parts = None
    for name in dict.fromkeys(m.table for m in metrics):
        own = [m for m in metrics if m.table == name]
        df = states(t.get(name), own, t.unique_keys)
        parts = df if parts is None else parts.unionByName(df)
    return values(parts, metrics, t.unique_keys)


# ---------------------------------------------------------------- kept by file

_FILE = ("table_name", "file", "size", "modified")
_LOGGED = "table_name STRING, file STRING, size BIGINT, modified BIGINT"


def files(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, file, size, modified, path) of the Parquet files of the
    tables, from their listing; ``file`` is how a scan names it."""
    out = None
    for name, path in paths.items():
        found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option(
            "recursiveFileLookup", "true").load(path).select(
            F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file"), F.col("length").alias("size"),
            F.unix_micros("modificationTime").alias("modified"), "path")
        out = found if out is None else out.unionByName(found)
    return out


def _log(spark: SparkSession, root: str) -> DataFrame:
    """The counted files and the batch whose states count: one, if two writers met."""
    log = spark.read.schema(f"{_LOGGED}, run_id STRING").parquet(f"{root}/files")
    return log.groupBy(*_FILE).agg(F.min("run_id").alias("run_id"))


def update(spark: SparkSession, paths: dict[str, str], root: str, metrics: list[Metric], unique_keys: dict | None = None) -> list[str]:
    """Read the files of the tables in the folders ``paths`` that ``root`` has no
    states of, and add theirs; returns those files. ``root`` belongs to one set
    of metrics."""
    present = files(spark, paths)
    if published.Folder(spark, f"{root}/files").names():
        present = present.join(_log(spark, root), list(_FILE), "left_anti")
    found = present.select(*_FILE, "path").collect()  # the paths that the reads below are given
    if not found:
        return []
    new = sorted(tuple(r)[:-1] for r in found)
    # the same files give the same name, so a replay after a crash between the two adds nothing twice
    batch = "b" + hashlib.sha256(repr(new).encode()).hexdigest()[:32]
    parts = None
    for name in dict.fromkeys(x[0] for x in new):
        own_files = [r.path for r in found if r.table_name == name]
        rows = spark.read.schema(SCHEMAS[name]).option("basePath", paths[name]).parquet(*own_files).select(
            "*", F.lit(name).alias("table_name"), F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_size").alias("size"), F.unix_micros("_metadata.file_modification_time").alias("modified"))
        own = states(rows, [m for m in metrics if m.table == name], unique_keys, _FILE)
        parts = own if parts is None else parts.unionByName(own)
    published.append_once(spark, f"{root}/states", batch, parts)
    # the log last: states of a batch that it doesn't name don't count, their files are read again
    published.append_once(spark, f"{root}/files", batch, spark.createDataFrame(new, _LOGGED))
    return [x[1] for x in new]


def current(spark: SparkSession, paths: dict[str, str], root: str, metrics: list[Metric], unique_keys: dict | None = None) -> DataFrame:
    """The metrics of the files that are there now, from their states alone."""
    there = _log(spark, root).join(files(spark, paths), list(_FILE), "left_semi")
    kept = spark.read.parquet(f"{root}/states").join(there, [*_FILE, "run_id"], "left_semi")
    return values(merged(kept), metrics, unique_keys)
