"""Collocations from a weighted de Bruijn graph of word grams.

Pieces of text are walks in a graph whose nodes are grams of four words and
whose edges are grams of five. Each place of a piece gives one edge, or, where
the piece ends before, the shorter gram that is left: Spark sums both. The flow
of a shorter gram is then the weight of all edges that begin with it plus the
piece ends that do, so texts are read for the longest grams alone. A gram whose
whole flow goes through one gram beside it is an inner node of a unary path; it
is compacted into the longer gram, which is how phrases inside equally frequent
phrases drop out. Scores join the flows of a phrase's two parts.

A phrase is no more frequent than its words, pairs and triples of words. A pass
over the texts for each finds those that occur often enough, as bit tables of a
fixed size over counts by 48-bit hash; a gram ends, as at the end of a piece,
where the next word would make a part of it that isn't in its table. A table
lets through some rare grams, the more the fuller it is, which costs time; it
never stops a frequent one, so the flows of phrases that are frequent enough are
exact at any size.

Defined results: null text is empty, a null language is ``und``; a language
without frequent phrases has no rows; each row counts, also of equal ids or
texts; texts are taken whole; ties are in byte order of the phrase; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm import textops as X
from shopsight.llm.common import bit_table, col, cut, in_table, slices, small_side, text_bytes

#: Bytes that end a piece; they become a line feed, tabs a space.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_AS = X.LOWER.copy()
_AS[list(PIECE_ENDS)] = 0x0A
_AS[0x09] = 0x20

_SPARE = X.U(16)  # hashes have 48 bits; equal ones only let a rare gram through
_KEYS = 1 << 22  # hashes that a task counts before it hands them on
_ROWS = 1 << 20  # different grams that a task sums before it hands them on
_PLACES = 1 << 18  # grams that are cut out of a text at a time
_RANKED = 1_000_000  # phrases of one language that one task orders


def first_words(phrase: str, k: Column) -> Column:
    """The first ``k`` words of a phrase, or with a negative ``k`` the last ones."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), k)


@dataclass(frozen=True)
class Mining:
    longest: int = 5
    filtered: int = 3  # grams of up to so many words are known to be frequent, or not, before the longest are made
    least: int = 100
    inside_percent: int = 100  # of its frequency in a longer phrase drops a phrase
    top: int = 2000


class Words(NamedTuple):
    """The words of some texts; ``beside``: the next one is in the same piece."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    beside: np.ndarray
    key: np.ndarray  # hash with the language


def words_of(b: pa.RecordBatch) -> Iterator[tuple[int, Words]]:
    """Words of the rows (text, lang), and the first row they belong to."""
    data, off = text_bytes(b.column(0))
    names, ends = text_bytes(b.column(1))
    salt = X.Hasher(names).of(ends[:-1], ends[1:]) if len(names) else np.zeros(b.num_rows, X.U)
    for x, y in slices(off):
        low = _AS[data[off[x] : off[y]]]
        starts, stops, rows = X.word_spans(low, off[x : y + 1] - off[x])
        stop = np.zeros(len(low) + 1, np.int64)
        np.cumsum(low == 0x0A, out=stop[1:])
        beside = np.zeros(len(starts), bool)
        beside[:-1] = (rows[1:] == rows[:-1]) & (stop[starts[1:]] == stop[stops[:-1]])
        yield x, Words(low, starts, stops, rows, beside, X.mix(X.Hasher(low).of(starts, stops) ^ salt[x + rows]) >> _SPARE)


def _then(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a gram and one more word."""
    return X.mix(key * X.U(0xA24BAED4963EE407) + word) >> _SPARE


def chains(w: Words, tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many words a frequent gram that begins at each word may have, as far
    as the ``tables`` (of grams of one word, of two, ...) tell; and the places and
    hashes of the grams of one word more whose parts may be frequent."""
    reach = np.zeros(len(w.key), np.int64)
    at, key = np.arange(len(w.key)), w.key
    for k, table in enumerate(tables, 1):
        known = in_table(table, key)
        at, key = at[known], key[known]
        reach[at] = k
        at, key = _grown(w, reach, at, key, k)
    return reach, at, key


def _grown(w: Words, reach: np.ndarray, at: np.ndarray, key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of k + 1 words at those places ``at`` where k words are followed by k."""
    more = w.beside[at]
    more[more] = reach[at[more] + 1] >= k
    at, key = at[more], key[more]
    return at, _then(key, w.key[at + k]) if len(at) else key


def _packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys as steps; the bytes of one place lie together, so that those
    that are hardly used take no room."""
    steps = np.diff(keys, prepend=X.U(0)).astype("<u8")
    planes = [x.view(np.uint8).reshape(len(keys), -1).T.tobytes() for x in (steps, counts.astype("<u4"))]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpacked(blob: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    planes = raw[: 8 * n].reshape(8, n).T, raw[8 * n :].reshape(4, n).T
    steps, counts = (np.ascontiguousarray(x) for x in planes)
    return np.cumsum(steps.view("<u8").ravel(), dtype=X.U), counts.view("<u4").ravel().astype(np.int64)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    kv, where = np.unique(np.concatenate(keys), return_inverse=True)
    return kv, np.bincount(where, np.concatenate(counts), len(kv)).astype(np.int64)


def _often(docs: DataFrame, least: int, tables: list) -> DataFrame:
    """Hashes of the grams of one word more than the ``tables`` hold that occur
    ``least`` times. A task's counts are dealt by hash into as many parts as
    there are tasks, so a part is about as large as one task's counts."""
    parts = docs.rdd.getNumPartitions()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        keys, counts, size = [], [], 0

        def out() -> pa.RecordBatch:
            kv, n = _summed(keys, counts)
            part = (kv >> X.U(16)) * X.U(parts) >> X.U(32)
            edges = np.r_[np.flatnonzero(np.r_[True, part[1:] != part[:-1]]), len(kv)]
            return pa.RecordBatch.from_arrays([
                pa.array(part[edges[:-1]].astype(np.int64)), pa.array(np.diff(edges)),
                pa.array([_packed(kv[i:j], n[i:j]) for i, j in zip(edges[:-1], edges[1:])], pa.binary())], names=["part", "n", "counts"])

        for b in batches:
            for _, w in words_of(b):
                kv, n = np.unique(chains(w, known)[2], return_counts=True)
                if len(kv):
                    keys.append(kv)
                    counts.append(n)
                    size += len(kv)
            if size >= _KEYS:
                yield out()
                keys, counts, size = [], [], 0
        if size:
            yield out()

    def add(t: pa.Table) -> pa.Table:
        kv, n = _summed(*zip(*(_unpacked(c.as_py(), k.as_py()) for c, k in zip(t.column("counts"), t.column("n")))))
        return pa.table({"kv": pa.array(kv[n >= least].view(np.int64))})

    return docs.mapInArrow(run, "part long, n long, counts binary").groupBy("part").applyInArrow(add, "kv long")


def _strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The substrings of ``data``; they may overlap."""
    size = end - start
    off = np.zeros(len(start) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    raw = data[np.repeat(start - off[:-1], size) + np.arange(off[-1])]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(off), pa.py_buffer(raw))


def _grams(w: Words, reach: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Row, number of words, and text of the gram of ``reach`` words at each word."""
    at = np.flatnonzero(reach)
    size = w.ends[at] - w.starts[at]
    place = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int((size + 1).sum()), 0x20, np.uint8)  # the words with one space after each
    inner = np.arange(int(size.sum()))
    shift = np.cumsum(size) - size
    joined[inner + np.repeat(place - shift, size)] = w.data[inner + np.repeat(w.starts[at] - shift, size)]
    for x in range(0, len(at), _PLACES):
        p = np.arange(x, min(x + _PLACES, len(at)))
        to = p + reach[at[p]] - 1
        yield w.rows[at[p]], reach[at[p]], _strings(joined, place[p], place[to] + size[to])


def graph(docs: DataFrame, rule: Mining) -> DataFrame:
    """(lang, m, gram, n) of (text, lang): edges of ``longest`` words, the shorter
    grams where a piece ends, and with m = 0 the number of all words of the language."""
    sc = docs.sparkSession.sparkContext
    tables: list = []
    for _ in range(min(rule.filtered, rule.longest)):
        tables.append(sc.broadcast(bit_table(_often(docs, rule.least, tables), "kv")))
    names = ["lang", "m", "gram", "n"]
    n_parts = docs.rdd.getNumPartitions()

    def summed(tables: list[pa.Table]) -> pa.Table:
        t = pa.concat_tables(tables).group_by(names[:3], use_threads=False).aggregate([("n", "sum")])
        return t.rename_columns(names)

    def dealt(t: pa.Table) -> pa.RecordBatch:
        """Grams in as many parts as there are tasks, each part as one value."""
        t = t.sort_by([("lang", "ascending"), ("gram", "ascending")]).combine_chunks()
        data, off = text_bytes(t.column("gram"))
        part = (X.Hasher(data).of(off[:-1], off[1:]) >> X.U(32)) * X.U(n_parts) >> X.U(32)
        order = np.argsort(part, kind="stable")
        edges = np.r_[np.flatnonzero(np.r_[True, np.diff(part[order]) > 0]), len(order)]
        blobs = []
        for i, j in zip(edges[:-1], edges[1:]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, t.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(t.take(pa.array(order[i:j])).combine_chunks())
            blobs.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays(
            [pa.array(part[order[edges[:-1]]].astype(np.int64)), pa.array(blobs, pa.binary())], names=["part", "grams"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [t.value for t in tables]
        parts, rows = [], 0
        for b in batches:
            lang = b.column(1).cast(pa.large_string())
            for x, w in words_of(b):
                reach, at, key = chains(w, known)
                for k in range(len(known) + 1, rule.longest + 1):  # no table tells of these
                    reach[at] = k
                    at, key = _grown(w, reach, at, key, k)
                of, n = np.unique(w.rows, return_counts=True)
                found = [(of, np.zeros(len(of), np.int64), pa.array([""] * len(of), pa.large_string()), n)]
                found += [(*g, np.ones(len(g[0]), np.int64)) for g in _grams(w, reach)]
                for row, m, gram, n in found:
                    parts.append(pa.table([lang.take(pa.array(x + row)), pa.array(m, pa.int32()), gram, pa.array(n)], names=names))
                    rows += len(row)
                if rows >= 2 * _ROWS:
                    parts = [summed(parts)]
                    rows = parts[0].num_rows
                    if rows > _ROWS:  # too many different ones to go on
                        yield dealt(parts[0])
                        parts, rows = [], 0
        if rows:
            yield dealt(summed(parts))

    def add(t: pa.Table) -> pa.Table:
        got = summed([pa.ipc.open_stream(g.as_buffer()).read_all() for g in t.column("grams")])
        return got.cast(pa.schema([("lang", pa.string()), ("m", pa.int32()), ("gram", pa.string()), ("n", pa.int64())]))

    out = cut(docs.mapInArrow(run, "part long, grams binary").groupBy("part").applyInArrow(
        add, "lang string, m int, gram string, n long"))
    for table in tables:
        table.destroy()
    return out


def flows(edges: DataFrame, rule: Mining) -> DataFrame:
    """(lang, k, phrase, f): the frequent phrases of up to ``longest`` words."""
    begins = edges.where("m > 0").select("lang", "n", "gram", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("k"))
    return begins.groupBy("lang", "k", first_words("gram", F.col("k")).alias("phrase")).agg(
        F.sum("n").alias("f")).where(F.col("f") >= rule.least)


def compacted(found: DataFrame, rule: Mining) -> DataFrame:
    """The phrases of two words or more that are no inner nodes of a unary path:
    one word more, before or after, keeps less than their flow. (A longer phrase
    that keeps it contains one of these.)"""
    beside = F.explode(F.array(*(first_words("phrase", s * (F.col("k") - 1)) for s in (1, -1))))
    most = found.where("k > 2").select("lang", "f", beside.alias("phrase")).groupBy("lang", "phrase").agg(
        F.max("f").alias("most"))
    kept = 100 * F.coalesce(F.col("most"), F.lit(0)) < rule.inside_percent * F.col("f")
    return found.where("k > 1").join(most, ["lang", "phrase"], "left").where(kept).drop("most")


def _exact(x: Column | str) -> Column:
    """Counts up to 10^15, whose products with each other fit a DECIMAL(38, 0)."""
    return (F.col(x) if isinstance(x, str) else x).cast("decimal(15,0)")


def scored(found: DataFrame, totals: DataFrame, rule: Mining) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) by the lowest cut of each phrase.
    ``totals`` has a row a language; ``found`` is kept."""
    word = small_side(found.select("lang", "phrase", "f"))
    part = lambda n, c: word.select("lang", F.col("phrase").alias(n), F.col("f").alias(c))
    cuts = compacted(found, rule).select(
        "lang", "phrase", F.col("f").alias("a"), "k", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", first_words("phrase", F.col("cut")).alias("head"),
        first_words("phrase", F.col("cut") - F.col("k")).alias("tail"))
    cuts = cuts.join(part("head", "l"), ["lang", "head"]).join(part("tail", "r"), ["lang", "tail"]).join(
        small_side(totals), "lang")
    score = F.call_function("div", _exact(F.lit(1000)).cast("decimal(4,0)") * _exact("a") * _exact("n"),
                            _exact("l") * _exact("r"))
    lowest = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x"))
    return lowest.select("lang", "phrase", "a", "x.l", "x.r", "n", "x.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", rule: Mining = Mining()) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    plain = docs.select(F.coalesce(col(text).cast("string"), F.lit("")).alias("text"),
                        F.coalesce(col(lang).cast("string"), F.lit("und")).alias("lang"))
    edges = graph(plain, rule)
    totals = cut(edges.where("m = 0").select("lang", "n"))
    best = cut(scored(cut(flows(edges, rule)), totals, rule))
    # a language's phrases are first cut to ``top`` in parts that one task can order
    parts = 1 + best.count() // _RANKED
    by = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    first = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts))).withColumn(
        "rank", place("lang", "part")).where(F.col("rank") <= rule.top)
    ranked = first.withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= rule.top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
