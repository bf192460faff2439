"""Exact distinct counts as mergeable bitmaps.

``COUNT(DISTINCT id)`` per store says nothing about the count per region: the
counts can't be added. A state can: the ids of a group as 64-bit words of a
bitmap, one row for each word that has a bit set. States of finer groups merge
into coarser ones with ``bit_or``, and a group's distinct count is the number of
bits set in its words, so one pass over the rows serves every level above it.

A row takes a word's number and bits whatever the number of ids in it: with
dense ids 64 of them share one row, with scattered ids a row holds one, as a
shuffle of (group, id) pairs would. (The built-in bitmaps of 4 KB take 4 KB for
a store and month with three customers, too.) Merging is a plain hash
aggregation of LONGs: it combines map-side and stays in generated code.

One state can hold several distinct counts (``of`` names them) and sums, which
belong to the rows of the first. NULL ids count nowhere, as in SQL; their rows
stay in the sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_INTEGERS = ("byte", "short", "integer", "long")


def word(c: Column) -> Column:
    return F.shiftright(c.cast("long"), 6)


def bit(c: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), c.cast("long").bitwiseAND(F.lit(63)).cast("int"))


def states(rows: DataFrame, keys: list[str], distinct: dict[str, str], sums: dict[str, Column] | None = None) -> DataFrame:
    """Rows (keys, of, word, bits, sums): ``distinct`` maps names of counts to
    integer columns, ``sums`` names to the values that are added up."""
    for c in distinct.values():
        if rows.schema[c].dataType.typeName() not in _INTEGERS:
            raise TypeError(f"a bitmap holds integers, column {c!r} has none")
    values = dict(sums or {})
    # values first: a sum may have the name of a column that it is made of
    named = {f"_s{i}": v for i, v in enumerate(values.values())}
    if len(distinct) == 1:
        ((name, c),) = distinct.items()
        flat = rows.select(*keys, word(F.col(c)).alias("word"), bit(F.col(c)).alias("bits"),
                           *(v.alias(n) for n, v in named.items()))
        out = flat.groupBy(*keys, "word").agg(F.bit_or("bits").alias("bits"), *(F.sum(n).alias(v) for n, v in zip(named, values)))
        return out.select(*keys, F.lit(name).alias("of"), "word", "bits", *values)
    typed = rows.select(*dict.fromkeys([*keys, *distinct.values()]), *(v.alias(n) for n, v in named.items()))
    types = {f.name: f.dataType for f in typed.schema.fields}
    each = [F.struct(F.lit(name).alias("of"), word(F.col(c)).alias("word"), bit(F.col(c)).alias("bits"),
                     *((F.col(n) if i == 0 else F.lit(None).cast(types[n])).alias(n) for n in named))
            for i, (name, c) in enumerate(distinct.items())]
    flat = typed.select(*keys, F.inline(F.array(*each)))
    return flat.groupBy(*keys, "of", "word").agg(
        F.bit_or("bits").alias("bits"), *(F.sum(n).alias(v) for n, v in zip(named, values)))


def merged(df: DataFrame, keys: list[str], sums: list[str], also: dict[str, str] | None = None) -> DataFrame:
    """States of coarser groups. ``also`` counts distinct values of columns that
    the finer groups have (the stores of a region, say)."""
    if also:
        types = {f.name: f.dataType for f in df.schema.fields}
        each = [F.struct("of", "word", "bits", *sums)] + [
            F.struct(F.lit(name).alias("of"), word(F.col(c)).alias("word"), bit(F.col(c)).alias("bits"),
                     *(F.lit(None).cast(types[s]).alias(s) for s in sums)) for name, c in also.items()]
        df = df.select(*keys, F.inline(F.array(*each)))
    return df.groupBy(*keys, "of", "word").agg(F.bit_or("bits").alias("bits"), *(F.sum(s).alias(s) for s in sums))


def counted(df: DataFrame, keys: list[str], distinct: list[str], sums: list[str]) -> DataFrame:
    """One row a group of states that are already merged to ``keys``: the
    distinct counts and the sums."""
    counts = [F.coalesce(F.sum(F.when(F.col("of") == n, F.bit_count("bits"))), F.lit(0)).cast("long").alias(n) for n in distinct]
    return df.groupBy(*keys).agg(*counts, *(F.sum(s).alias(s) for s in sums))
