"""Exact n-gram Jaccard join with a token-group matrix.

Documents are sets of word shingles. Equal sets are one class. Tokens have one
global order, the rarest first by a fixed-size table of counts; two sets that
are similar enough share tokens among the first few of each (the prefix), at least
a known number of them. Classes with so many shared tokens are partitioned into groups of similar
sets of bounded size; a group keeps the union of its members' tokens, its row
of the matrix. Inside a group every pair is measured. A query meets a group only
through a shared prefix token, is bounded by its overlap with the group's union,
and opens the group only if that bound allows a link.

Only what joins components is needed, so groups first meet through one
representative of each component, and then all queries of a component that is
smaller than one of the group's. A family of near copies of any size is linked this way
without writing out its pairs.

Defined results: null, empty or blank text is an empty set, linked with nothing;
fewer words than a shingle are one shingle; equal rows are one class; a null id
is larger than any other; very long texts are taken whole; an empty table gives
an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm import textops as X
from shopsight.llm.common import col, cut, fresh, map_rows, slices, small_side, sweep, text_bytes, trimmed
from shopsight.llm.components import components


@dataclass(frozen=True)
class Join:
    """``count_cells`` sets the order of tokens only; any value gives the same
    links. Raise it with the number of tokens, 8 bytes a cell."""

    shingle: int = 4
    percent: int = 85
    group: int = 256
    queries: int = 4096
    count_cells: int = 1 << 20


_CHUNK = 1 << 14
#: A set of n tokens has 1 + n // _MORE tokens more in its prefix than one shared
#: token needs, and so has to share as many.
_MORE = 20


def token_sets(column: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Slice by slice: the distinct shingles of the rows, and offsets of rows."""
    data, off = text_bytes(column)
    for a, b in slices(off):
        low, at = X.LOWER[data[off[a] : off[b]]], off[a : b + 1] - off[a]
        starts, ends, rows = X.word_spans(low, at)
        key, first = X.shingles(X.Hasher(low).of(starts, ends), rows, n, short=True)
        row = rows[first]
        order = np.lexsort((key, row))
        key, row = key[order], row[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        key, row = key[new], row[new]
        yield key, np.r_[0, np.cumsum(np.bincount(row, minlength=b - a))]


def _set_keys(key: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """128 bits for each set, independent of order; None for the empty set."""
    sums = [np.r_[X.U(0), np.cumsum(X.mix(key ^ X.U(s)))] for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
    two = [X.mix((s[at[1:]] - s[at[:-1]]) + np.diff(at).astype(X.U)) for s in sums]
    both = np.stack(two, axis=1).astype("<u8").tobytes()
    return [both[16 * i : 16 * i + 16] if at[i + 1] > at[i] else None for i in range(len(at) - 1)]


def token_counts(docs: DataFrame, rule: Join) -> np.ndarray:
    """A table of fixed size: how many sets have a token of each cell."""
    cells, width = rule.count_cells, min(_CHUNK, rule.count_cells)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(cells, np.int64)
        for b in batches:
            for key, _ in token_sets(b.column(0), rule.shingle):
                table += np.bincount((key & X.U(cells - 1)).astype(np.int64), minlength=cells)
        parts = [table[i : i + width] for i in range(0, cells, width)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(parts))), pa.array([p.tobytes() for p in parts], pa.binary())], names=["part", "n"])

    def add(t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in t.column("n"))
        return pa.table({"part": t.column("part")[:1], "n": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, n binary"
    rows = docs.mapInArrow(trimmed(count), schema).groupBy("part").applyInArrow(add, schema).collect()
    table = np.zeros(cells, np.int64)
    for r in rows:
        table[r.part * width : (r.part + 1) * width] = np.frombuffer(r.n, np.int64)
    return table


def with_sets(docs: DataFrame, text: str, rule: Join, size: str, key: str) -> DataFrame:
    """``docs`` and two columns: size and 128-bit key of its set."""
    at = docs.columns.index(text)
    n = rule.shingle

    def arrays(b: pa.RecordBatch) -> list[pa.Array]:
        sizes, keys = [], []
        for tokens, off in token_sets(b.column(at), n):
            sizes.append(np.diff(off))
            keys += _set_keys(tokens, off)
        return [pa.array(np.concatenate(sizes) if sizes else [], pa.int64()), pa.array(keys, pa.binary())]

    return map_rows(docs, arrays, [T.StructField(size, T.LongType()), T.StructField(key, T.BinaryType())])


def _prefixes(docs: DataFrame, rule: Join, counts) -> DataFrame:
    """(doc_id, n, cid, prefix) of (text, doc_id)."""
    n, percent = rule.shingle, rule.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        for b in batches:
            sizes, keys, kept, ends, seen = [], [], [], [0], set()
            for tokens, off in token_sets(b.column(0), n):
                size = np.diff(off)
                rows = np.repeat(np.arange(len(size)), size)
                often = table[(tokens & X.U(len(table) - 1)).astype(np.int64)]
                order = np.lexsort((tokens, often, rows))
                rank = np.arange(len(tokens)) - off[rows]
                # all but this many tokens are shared with a linked set, so
                # 1 + size // _MORE of these are
                need = np.minimum(size - -(-percent * size // 100) + 1 + size // _MORE, size)
                own = _set_keys(tokens, off)
                # copies in one batch give their prefix once
                new = np.array([k is not None and not (k in seen or seen.add(k)) for k in own], bool)
                need = np.where(new, need, 0)
                kept.append(tokens[order][rank < need[rows]])
                ends += (np.cumsum(need) + ends[-1]).tolist()
                sizes.append(size)
                keys += own
            flat = np.concatenate(kept).view(np.int64) if kept else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column(1), pa.array(np.concatenate(sizes) if sizes else [], pa.int64()), pa.array(keys, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["doc_id", "n", "cid", "prefix"])

    return docs.mapInArrow(trimmed(run), "doc_id long, n long, cid binary, prefix array<bigint>")


def _pack(tokens: np.ndarray) -> bytes:
    """Tokens as 48 bits each: two sets of 1000 clash in a token once in 10**8 pairs."""
    return (tokens >> X.U(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(packed, np.uint8).reshape(-1, 6)
    return np.sort(wide.view("<i8").ravel())


def _full_sets(docs: DataFrame, rule: Join) -> DataFrame:
    """(cid, n, tokens) of (text, cid), where the text's set is that class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted, row = b.column(1).to_pylist(), 0
            out: dict[str, list] = {"cid": [], "n": [], "tokens": []}
            for tokens, off in token_sets(b.column(0), rule.shingle):
                for i, k in enumerate(_set_keys(tokens, off)):
                    if k is not None and k == wanted[row]:
                        out["cid"].append(k)
                        out["n"].append(int(off[i + 1] - off[i]))
                        out["tokens"].append(_pack(tokens[off[i] : off[i + 1]]))
                    row += 1
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("cid", pa.binary()), ("n", pa.int64()), ("tokens", pa.binary())]))

    return docs.mapInArrow(trimmed(run), "cid binary, n long, tokens binary")


class Group:
    """The members of a group and their union of tokens, the matrix's row."""

    def __init__(self, cids: list[bytes], sets: list[np.ndarray]) -> None:
        self.cids, self.sizes = cids, np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        self.union, column = np.unique(flat, return_inverse=True)
        shared = np.bincount(column) > 1
        place = np.cumsum(shared) - 1
        rows = np.repeat(np.arange(len(sets)), self.sizes)
        keep = shared[column]
        self.matrix = np.zeros((len(sets), int(shared.sum())), np.float32)
        self.matrix[rows[keep], place[column[keep]]] = 1
        self.column, self.rows = column, rows

    def links(self, percent: int) -> np.ndarray:
        """Which members are linked, as a matrix."""
        both = (self.matrix @ self.matrix.T).astype(np.int64)
        np.fill_diagonal(both, self.sizes)
        whole = self.sizes[:, None] + self.sizes[None, :] - both
        return 100 * both >= percent * whole

    def linked_to(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Members linked with a query; none if the union's bound forbids it."""
        at = np.minimum(np.searchsorted(self.union, query), len(self.union) - 1)
        hit = at[self.union[at] == query]
        if 100 * len(hit) < percent * len(query):
            return np.zeros(0, np.int64)
        has = np.zeros(len(self.union), bool)
        has[hit] = True
        both = np.bincount(self.rows[has[self.column]], minlength=len(self.sizes))
        return np.flatnonzero(100 * both >= percent * (self.sizes + len(query) - both))


def _labels(linked: np.ndarray) -> np.ndarray:
    """The smallest reachable index of each."""
    label = np.arange(len(linked))
    while True:
        after = np.where(linked, label[None, :], len(linked)).min(axis=1)
        if (after == label).all():
            return label
        label = after


def _read(t: pa.Table) -> tuple[list[bytes], list[np.ndarray]]:
    """Members by class key, each class once."""
    found = dict(zip(t.column("cid").to_pylist(), t.column("tokens").to_pylist(), strict=True))
    cids = sorted(found)
    return cids, [_unpack(found[c]) for c in cids]


def class_labels(rows: DataFrame, reps: DataFrame, docs: DataFrame, rule: Join) -> DataFrame:
    """(cid, label) of the classes that share prefix tokens with others.

    ``rows``: (doc_id, n, cid, prefix); ``reps``: (cid, n, doc_id), one row a
    class; ``docs``: (text, doc_id).
    """
    # 64 bits of a class do for finding candidates: a clash adds one, loses none.
    # The last 8 tell how many tokens it has to share (255: or more): the
    # smaller of two linked sets has ``percent`` of the other's tokens at least.
    must = F.least(F.floor(F.col("n") * rule.percent / (100 * _MORE)) + 1, F.col("n"), F.lit(255)).cast("long")
    short = F.xxhash64("cid").bitwiseAND(F.lit(~255)).bitwiseOR(must).alias("c64")
    postings = rows.select(F.explode("prefix").alias("token"), short)
    often = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
    some = cut(postings.join(often, "token").distinct())
    sweep(docs.sparkSession)  # shuffles and checkpoints that are done with, before the next ones
    for _ in range(2):  # tokens of two classes; classes with enough of them
        two = some.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("token")
        some = some.join(two, "token")
        enough = some.groupBy("c64").agg(F.count(F.lit(1)).alias("s")).where(
            F.col("s") >= F.col("c64").bitwiseAND(F.lit(255))).select("c64")
        some = cut(some.join(enough, "c64").select("token", "c64"))
        del two, enough
        sweep(docs.sparkSession)
    named = cut(reps.select(short, "cid", "n").join(some.select("c64").distinct(), "c64"))
    count = some.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    shared = cut(some.join(small_side(named), "c64").join(count, "token").select("token", "cid", "n", "c"))
    del some, count, postings, often
    sweep(docs.sparkSession)

    # home of a class: its most shared token, in parts of bounded size
    home = cut(shared.groupBy("cid").agg(F.max(F.struct("c", "token")).alias("h")).select("cid", F.col("h.token").alias("home")))
    parts = home.groupBy("home").agg(F.ceil(F.count(F.lit(1)) / F.lit(rule.group)).cast("long").alias("parts"))
    home = cut(home.join(parts, "home").select("cid", "home", F.pmod(F.xxhash64("cid"), "parts").alias("part")))
    wanted = home.join(reps.select("cid", "doc_id"), "cid")
    wanted = small_side(cut(wanted.select(F.struct("doc_id").alias("d"), "cid")))
    texts = docs.withColumn("d", F.struct("doc_id")).join(wanted, "d").select("text", "cid")
    members = _full_sets(texts, rule).join(home, "cid")

    def inside(t: pa.Table) -> pa.Table:
        cids, sets = _read(t)
        own = dict(zip(t.column("cid").to_pylist(), t.column("tokens").to_pylist(), strict=True))
        label = _labels(Group(cids, sets).links(rule.percent))
        first = [t.column(c)[0].as_py() for c in ("home", "part")]
        return pa.table({
            "home": pa.array([first[0]] * len(cids), pa.int64()), "part": pa.array([first[1]] * len(cids), pa.int64()),
            "cid": pa.array(cids, pa.binary()), "n": pa.array([len(s) for s in sets], pa.int64()),
            "tokens": pa.array([own[c] for c in cids], pa.binary()), "label": pa.array([cids[i] for i in label], pa.binary())})

    groups = cut(members.groupBy("home", "part").applyInArrow(
        inside, "home long, part long, cid binary, n long, tokens binary, label binary"))
    named = cut(groups.select("cid", "home", "part", "label"))
    for everyone in (False, True):
        links = cut(_meet(groups, named, shared, rule, everyone))
        if links.isEmpty():
            continue
        merged = components(links).select(F.col("node").alias("old"), F.col("label").alias("to"))
        named = cut(named.join(merged, named.label == merged.old, "left").select(
            "cid", "home", "part", F.coalesce("to", "label").alias("label")))
    return named.select("cid", "label")


def _meet(groups: DataFrame, named: DataFrame, shared: DataFrame, rule: Join, everyone: bool) -> DataFrame:
    """Links (a, b) of labels, found between groups. Queries are all classes, or
    one of each label of several. Of two labels only the smaller one asks, so that
    few classes which belong nowhere don't make a whole family ask; a group is
    met once, whatever labels it has."""
    percent = rule.percent
    spots = shared.join(named, "cid").join(named.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "label")
    held = spots.groupBy("token", "home", "part").agg(
        F.max(F.struct("size", "label")).alias("held"), F.min("n").alias("least"), F.max("n").alias("most"))
    asks = spots if everyone else spots.where("size > 1").join(
        named.groupBy("label").agg(F.min("cid").alias("cid")).select("cid"), "cid", "left_semi")
    asks = asks.select("token", "cid", "label", F.struct("size", "label").alias("own"), "n",
                       F.col("home").alias("h"), F.col("part").alias("p"))
    met = asks.join(held, "token").where(
        ((F.col("h") != F.col("home")) | (F.col("p") != F.col("part"))) & (F.col("own") < F.col("held"))
        & (100 * F.col("most") >= percent * F.col("n")) & (100 * F.col("n") >= percent * F.col("least"))
    ).select("cid", "label", "home", "part").distinct()
    met = cut(met)
    if met.isEmpty():
        return met.select(F.col("label").alias("a"), F.col("label").alias("b"))
    # token sets are narrowed to the groups and queries that meet before they move
    turns = cut(met.groupBy("home", "part").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rule.queries)).cast("long").alias("turns")))
    asked = cut(met.join(turns, ["home", "part"]).select(
        "home", "part", F.pmod(F.xxhash64("cid"), "turns").alias("turn"), "cid", "label"))
    asked = groups.select("cid", F.col("tokens").alias("query")).join(small_side(asked), "cid").select(
        *(F.col(c).alias(f"q_{c}") for c in ("home", "part", "turn", "label", "query")))
    opened = groups.drop("label").join(small_side(turns), ["home", "part"]).join(
        small_side(named.select("cid", "label")), "cid").withColumn(
        "turn", F.explode(F.sequence(F.lit(0).cast("long"), F.col("turns") - 1)))

    def verify(members: pa.Table, queries: pa.Table) -> pa.Table:
        links: set[tuple[bytes, bytes]] = set()
        if members.num_rows and queries.num_rows:
            label = dict(zip(members.column("cid").to_pylist(), members.column("label").to_pylist(), strict=True))
            cids, sets = _read(members)
            group = Group(cids, sets)
            for own, tokens in zip(queries.column("q_label").to_pylist(), queries.column("q_query").to_pylist(), strict=True):
                for i in group.linked_to(_unpack(tokens), percent):
                    if label[cids[i]] != own:
                        links.add((own, label[cids[i]]))
        a, b = zip(*sorted(links), strict=True) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    key = ("home", "part", "turn")
    return opened.select(*key, "cid", "tokens", "label").groupBy(*key).cogroup(
        asked.groupBy(*(f"q_{c}" for c in key))).applyInArrow(verify, "a binary, b binary").distinct()


def class_table(docs: DataFrame, text: str, doc_id: str, rule: Join) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n, cid), and classes (cid, component_id, first), where
    ``first`` marks the class that holds the component's smallest id."""
    spark = docs.sparkSession
    plain = docs.select(col(text).cast("string").alias("text"), col(doc_id).cast("long").alias("doc_id"))
    counts = spark.sparkContext.broadcast(token_counts(plain.select("text"), rule))
    rows = cut(_prefixes(plain, rule, counts))
    reps = cut(rows.where(F.col("cid").isNotNull()).groupBy("cid").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("doc_id")))
    labels = class_labels(rows, reps, plain, rule)
    named = reps.select("cid", "doc_id").join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    top = named.groupBy("label").agg(F.min("doc_id").alias("component_id"), F.min(
        F.struct(F.col("doc_id").isNull(), "doc_id", "cid")).alias("m")).select("label", "component_id", F.col("m.cid").alias("top"))
    classes = named.join(top, "label").select("cid", "component_id", (F.col("cid") == F.col("top")).alias("first"))
    return rows.select("doc_id", "n", "cid"), cut(classes)


def linked(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Join = Join()) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id."""
    rows, classes = class_table(docs, text, doc_id, rule)
    return rows.join(classes, "cid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("cid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rule: Join = Join()) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id;
    documents without words all stay."""
    rows, classes = class_table(docs, text, doc_id, rule)
    del rows  # their prefixes go before the texts are shuffled
    sweep(docs.sparkSession)
    size, key, want = fresh(docs, "n_shingles"), fresh(docs, "cid"), fresh(docs, "component_id")
    keep = classes.where("first").select(F.col("cid").alias(key), F.col("component_id").alias(want))
    keyed = with_sets(docs, text, rule, size, key)
    names = [col(c) for c in docs.columns]
    one = keyed.join(keep, key).where(col(doc_id).cast("long").eqNullSafe(F.col(want))).dropDuplicates([key])
    return one.select(*names).unionByName(keyed.where(F.col(key).isNull()).select(*names))
