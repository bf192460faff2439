"""NTILE by selection: the rows at the tiles' ends, without ordering the rows.

NTILE(k) needs only the k - 1 rows that end a tile. Each is found by its
position: counts of equal cells between the least and the greatest value tell
which cell holds the position, the next pass divides that cell, until a cell is
one value. Where a tile ends among rows of one value, and only there, the search
goes on in the tie-break column, among those rows. All orderings and all ends
are searched in the same passes; a pass shuffles at most ``CELLS`` counts an end
whatever the number of rows, and a row's tile is then one expression: one more
than the number of ends that it comes after.

Keys are integers, dates, timestamps, booleans or decimals (``fits``); a pass
divides a range by ``CELLS``, so 64-bit values take five passes at most.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

CELLS = 8192
MAX_TILES = 100  # a row's tile is one expression over all ends
_WIDE = 1 << 62


@dataclass
class _End:
    """The search for the row at ``position`` (from 1) of one ordering."""

    ordering: int
    position: int
    low: int
    high: int
    within: int  # rows that share the prefix and lie between low and high
    before: int = 0  # rows that come before those
    prefix: tuple[int, ...] = field(default=())
    found: bool = False


def tile_ends(n: int, k: int) -> list[int]:
    """Positions of the last rows of the first k - 1 of k tiles of n rows."""
    base, rest = divmod(n, k)
    return [j * base + min(j, rest) for j in range(1, k)]


def _literal(v: int) -> Column:
    return F.lit(v) if -_WIDE < v < _WIDE else F.lit(Decimal(v)).cast("decimal(38,0)")


def ends(df: DataFrame, orderings: list[list[str]], positions: list[list[int]]) -> list[list[tuple[int, ...]]]:
    """The keys at the given positions of each ordering. Orderings list
    null-free integer columns (DECIMAL(38,0) or smaller); a key that is shorter
    than its ordering ends after the last row with those values."""
    columns = list(dict.fromkeys(c for o in orderings for c in o))
    row = df.agg(F.count(F.lit(1)), *(f(c) for c in columns for f in (F.min, F.max))).first()
    n = row[0]
    if not n:
        return [[] for _ in orderings]
    bounds = {c: (int(row[1 + 2 * i]), int(row[2 + 2 * i])) for i, c in enumerate(columns)}
    # a column whose values are narrow is computed with as LONG
    narrow = {c for c, (low, high) in bounds.items() if -_WIDE < low and high < _WIDE and high - low < _WIDE}
    value = {c: F.col(c).cast("long") if c in narrow else F.col(c).cast("decimal(38,0)") for c in columns}
    targets = [[_End(i, p, *bounds[o[0]], n) for p in ps] for i, (o, ps) in enumerate(zip(orderings, positions, strict=True))]
    searched = [e for es in targets for e in es]

    def settle(e: _End) -> None:
        """Go on to the next column as long as the value is known."""
        order = orderings[e.ordering]
        while not e.found and e.low == e.high:
            e.prefix += (e.low,)
            e.found = len(e.prefix) == len(order) or e.position == e.before + e.within
            if not e.found:
                e.low, e.high = bounds[order[len(e.prefix)]]

    while True:
        for e in searched:
            settle(e)
        ranges = list(dict.fromkeys((e.ordering, e.prefix, e.low, e.high) for e in searched if not e.found))
        if not ranges:
            return [[e.prefix for e in es] for es in targets]
        size = [-(-(high - low + 1) // CELLS) for _, _, low, high in ranges]
        cells = []
        for r, (i, prefix, low, high) in enumerate(ranges):
            order = orderings[i]
            inside = value[order[len(prefix)]].between(_literal(low), _literal(high))
            for c, v in zip(order, prefix):
                inside = inside & (value[c] == _literal(v))
            cell = F.call_function("div", value[order[len(prefix)]] - _literal(low), _literal(size[r])).cast("int")
            cells.append(F.when(inside, F.struct(F.lit(r).alias("r"), cell.alias("cell"))))
        counts = df.select(F.inline(F.filter(F.array(*cells), lambda x: x.isNotNull()))).groupBy("r", "cell").count()
        found: dict[int, list[tuple[int, int]]] = {}
        for x in counts.collect():  # CELLS a range at most
            found.setdefault(x["r"], []).append((x["cell"], x["count"]))
        for e in searched:
            if e.found:
                continue
            r = ranges.index((e.ordering, e.prefix, e.low, e.high))
            for cell, count in sorted(found[r]):
                if e.before + count >= e.position:
                    e.low += cell * size[r]
                    e.high = min(e.high, e.low + size[r] - 1)
                    e.within = count
                    break
                e.before += count


def after(order: list[str], key: tuple[int, ...]) -> Column:
    """Whether a row comes after the rows of ``key``."""
    out = F.lit(False)
    for c, v in reversed(list(zip(order, key))):
        x = F.col(c).cast("decimal(38,0)")
        limit = F.lit(Decimal(v)).cast("decimal(38,0)")
        out = (x > limit) | ((x == limit) & out)
    return out


def integer_key(df: DataFrame, column: Column, name: str) -> Column:
    """``column`` as an integer of the same order."""
    dtype = df.select(column.alias(name)).schema[name].dataType
    scale = getattr(dtype, "scale", 0)
    return (column * F.lit(Decimal(10) ** scale) if scale else column).cast("decimal(38,0)")


def fits(df: DataFrame, columns: list[str]) -> bool:
    """Whether all columns are of types that selection can divide into cells."""
    plain = ("byte", "short", "integer", "long", "date", "timestamp", "timestamp_ntz", "boolean")
    types = [df.schema[c].dataType for c in columns]
    return all(t.typeName() in plain or (t.typeName() == "decimal" and t.precision + t.scale <= 36) for t in types)
