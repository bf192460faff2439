"""Substring deduplication: what a longest-previous-factor array of threshold
``length`` would mark, found by fingerprints.

No suffix array, longest-previous-factor array or search for smaller positions
is computed. The only question is which strings of ``length`` bytes occur
elsewhere, too (matches never cross documents), and equal strings are found by
equal 64-bit fingerprints. ``keep="first"`` removes what has an earlier match,
``keep="none"`` what has an earlier or a later one.

Each start belongs to the minimizer of the k-grams
after it, which depends on the string alone, so equal strings belong to equal
minimizers at equal distances. Per minimizer, only a fingerprint of what all of
its strings share is compared at first (about one row in 100 bytes); only where
that repeats, fingerprints of the whole stretch; and only where stretches of one
minimizer differ, those of single strings, once for each distinct stretch. So
any number of equal copies costs one stretch. A task compares a bounded number of
stretches: those of a minimizer with more than ``IN_TASK`` are joined string by string.

Defined results: null text is empty; a document shorter than ``length`` loses
nothing; equal rows (id and text) are separate documents, but have one place
among the matches, so ``keep="first"`` keeps them all or none; overlapping matches count; texts of
any length are taken whole; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm import textops as X
from shopsight.llm.common import col, cut, slices, small_side, text_bytes, trimmed

LENGTH = 400
GRAM = 16
_OUT_BYTES = 1 << 20  # of texts in one batch of results
#: Starts that may share a minimizer; larger: fewer rows, longer stretches.
REACH = 192
#: Stretches of one minimizer that may be compared in one task; minimizers with
#: more have their strings joined by Spark, row by row.
IN_TASK = 4096
#: Stretches that a task compares, about: 10 MB of fingerprints.
PER_TASK = 20_000
_PLACE = X.U((1 << 31) - 1)


def _sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` entries in a row."""
    size = 1
    while 2 * size <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    return np.minimum(v[: len(v) - (width - size)], v[width - size :]) if size < width else v


def stretches(data: np.ndarray, off: np.ndarray, length: int, hasher: X.Hasher) -> tuple[np.ndarray, ...]:
    """Minimizer, first and last start (inclusive) of each stretch, and its row."""
    empty = np.zeros(0, np.int64)
    reach = min(REACH, length - GRAM + 1)
    if len(data) < length:
        return empty, empty, empty, empty
    at = np.arange(len(data) - GRAM + 1)
    # ties go to the last place; 31 bits are the longest text that Arrow holds
    v = (hasher.of(at, at + GRAM) & ~_PLACE) | (_PLACE - at.astype(X.U))
    low = _sliding_min(v, reach)
    start = np.arange(min(len(low), len(data) - length + 1))
    row = np.searchsorted(off, start, "right") - 1
    fits = start + length <= off[row + 1]
    start, row = start[fits], row[fits]
    if not len(start):
        return empty, empty, empty, empty
    anchor = (_PLACE - (low[start] & _PLACE)).astype(np.int64)
    new = np.r_[True, (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])]
    head = np.flatnonzero(new)
    tail = np.r_[head[1:], len(start)] - 1
    return anchor[head], start[head], start[tail], row[head]


def _anchors(docs: DataFrame, length: int) -> DataFrame:
    """(p, f, doc_id, h, place): fingerprints of each stretch's shared part and
    whole, and where it is: minimizer, and distances of its starts, in one long."""
    reach = min(REACH, length - GRAM + 1)
    names = ["p", "f", "doc_id", "h", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = text_bytes(b.column(0))
            ids, hs = b.column(1), b.column(2).to_numpy(zero_copy_only=False)
            for x, y in slices(off):
                d, o = data[off[x] : off[y]], off[x : y + 1] - off[x]
                hasher = X.Hasher(d)
                a, s, e, row = stretches(d, o, length, hasher)
                if not len(a):
                    continue
                place = ((a - o[row]) << 16) | ((a - s) << 8) | (a - e)
                yield pa.RecordBatch.from_arrays([
                    pa.array(hasher.of(a, a + (length - reach + 1)).view(np.int64)),
                    pa.array(hasher.of(s, e + length).view(np.int64)),
                    ids.take(pa.array(x + row)), pa.array(hs[x + row]), pa.array(place)], names=names)

    return docs.select("text", "doc_id", "h").mapInArrow(trimmed(run), "p long, f long, doc_id long, h long, place long")


def _packed(docs: DataFrame) -> DataFrame:
    """(doc_id, h, z): texts packed for a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = [pack.compress((t.as_py() or "").encode()) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), pa.array(z, pa.binary())], names=["doc_id", "h", "z"])

    return docs.select("text", "doc_id", "h").mapInArrow(trimmed(run), "doc_id long, h long, z binary")


def _windows(texts: DataFrame, length: int) -> DataFrame:
    """(fid, p, big, doc_id, h, place, strings): fingerprints of the strings of each
    stretch that a text (z, doc_id, h, places: array of (place, fid, big, p)) stands for."""
    names = ["fid", "p", "big", "doc_id", "h", "place", "strings"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for z, doc, h, places in zip(b.column(0), *(b.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                data = np.frombuffer(unpack.decompress(z.as_py()), np.uint8)
                hasher = X.Hasher(data)
                place = np.array([p["place"] for p in places], np.int64)
                first = (place >> 16) - ((place >> 8) & 255)
                size = ((place >> 8) & 255) - (place & 255) + 1
                ends = np.r_[0, np.cumsum(size)]
                start = np.repeat(first - ends[:-1], size) + np.arange(ends[-1])
                yield pa.RecordBatch.from_arrays([
                    pa.array([p["fid"] for p in places], pa.int64()),
                    pa.array([p["p"] for p in places], pa.int64()), pa.array([p["big"] for p in places], pa.bool_()),
                    pa.array([doc] * len(places), pa.int64()), pa.array([h] * len(places), pa.int64()), pa.array(place),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
                        hasher.of(start, start + length).view(np.int64)))], names=names)

    return texts.select("z", "doc_id", "h", "places").mapInArrow(
        run, "fid long, p long, big boolean, doc_id long, h long, place long, strings array<bigint>")


def _compare(strings: DataFrame, keep: str) -> DataFrame:
    """(fid, some): the strings of each stretch, by number, that another stretch
    has, too (an earlier one, for keep="first"). All stretches of a minimizer
    are dealt to one task: equal strings have equal minimizers."""

    def mark(t: pa.Table) -> pa.Table:
        t = t.sort_by([(n, "ascending") for n in ("doc_id", "h", "place")])  # nulls last
        lists = t.column("strings").combine_chunks()
        flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
        _, first, inverse, counts = np.unique(flat, return_index=True, return_inverse=True, return_counts=True)
        hit = counts[inverse] > 1
        if keep == "first":
            hit &= first[inverse] != np.arange(len(flat))
        row = np.repeat(np.arange(len(sizes)), sizes)
        number = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        held = np.bincount(row[hit], minlength=len(sizes))
        some = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(held)], pa.int32()), pa.array(number[hit], pa.int32()))
        return pa.table({"fid": t.column("fid"), "some": some}).filter(pa.array(held > 0))

    return strings.groupBy("task").applyInArrow(mark, "fid long, some array<int>")


def _key() -> Column:
    return F.struct("doc_id", "h")  # a struct joins null ids, too


def repeats(docs: DataFrame, length: int, keep: str) -> DataFrame:
    """(doc_id, h, places): of each document of (text, doc_id, h) that has
    some, the starts to remove: (place, whole, list of starts by number)."""
    anchors = _anchors(docs, length)
    often = anchors.groupBy("p").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("p")
    found = cut(anchors.join(often, "p"))
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h", "place")
    kinds = found.groupBy("p", "f").agg(F.count(F.lit(1)).alias("m"), F.min(at).alias("first")).withColumn(
        "fid", F.xxhash64("p", "f"))
    kinds = cut(kinds)
    several = kinds.groupBy("p").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select(
        "p", (F.col("kinds") > IN_TASK).alias("big"))

    # stretches of one minimizer that differ: compare their strings
    stand = cut(kinds.join(several, "p").select("p", "fid", "big", "first"))
    per_text = cut(stand.groupBy(F.struct("first.doc_id", "first.h").alias("k")).agg(
        F.collect_list(F.struct("first.place", "fid", "big", "p")).alias("places")))
    tasks = max(1, -(-stand.count() // PER_TASK))
    asked = docs.withColumn("k", _key()).join(small_side(per_text.select("k")), "k", "left_semi")
    texts = _packed(asked).withColumn("k", _key()).dropDuplicates(["k"])
    strings = cut(_windows(texts.join(per_text, "k"), length))
    dealt = strings.where("NOT big").withColumn("task", F.pmod(F.xxhash64("p"), F.lit(tasks)))
    here = _compare(dealt.select("task", "fid", "doc_id", "h", "place", "strings"), keep)
    strings = strings.where("big").select("fid", at.alias("first"), F.posexplode("strings").alias("i", "string"))
    if keep != "first":
        strings = strings.drop("first")
    twice = strings.groupBy("string").agg(*([F.min("first").alias("least")] if keep == "first" else []),
                                          F.count(F.lit(1)).alias("c")).where("c > 1").drop("c")
    hit = strings.join(twice, "string")
    if keep == "first":
        hit = hit.where(F.col("first") != F.col("least"))
    partly = here.unionByName(hit.groupBy("fid").agg(F.collect_list("i").alias("some")))

    # a copy of the stretch elsewhere (earlier, for keep="first") removes it whole
    told = kinds.join(partly, "fid", "left").select("p", "f", "m", "first", "some").where(
        (F.col("m") > 1) | F.col("some").isNotNull())
    whole = (F.col("m") > 1) & (F.lit(keep != "first") | ~at.eqNullSafe(F.col("first")))
    return found.join(told, ["p", "f"]).select(
        "doc_id", "h", F.struct("place", whole.alias("whole"), F.when(~whole, F.col("some")).alias("some")).alias("x")
    ).where(F.col("x.whole") | F.col("x.some").isNotNull()).groupBy("doc_id", "h").agg(F.collect_set("x").alias("places"))


def removed(places: list[dict], size: int, length: int) -> np.ndarray:
    """Which of ``size`` bytes to remove, as flags."""
    change = np.zeros(size + 1, np.int64)
    for p in places:
        first = (p["place"] >> 16) - ((p["place"] >> 8) & 255)
        last = (p["place"] >> 16) - (p["place"] & 255)
        if p["whole"]:
            change[first] += 1
            change[last + length] -= 1
        else:
            starts = first + np.array(p["some"], np.int64)
            np.add.at(change, starts, 1)
            np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, keep: str = "none",
          with_text: bool = False) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and,
    if asked for, ``kept``: the remaining bytes."""
    if keep not in ("none", "first"):
        raise ValueError(f"keep is 'none' or 'first', not {keep!r}")
    if length < 2 * GRAM:
        raise ValueError(f"length is at least {2 * GRAM}")
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    plain = docs.select(t.alias("text"), col(doc_id).cast("long").alias("doc_id")).withColumn("h", F.xxhash64("text"))
    places = cut(repeats(plain, length, keep).select(_key().alias("k"), "places"))
    keyed = plain.withColumn("k", _key())
    has_some = small_side(places.select("k"))
    # only texts that lose something meet their places
    touched = _packed(keyed.join(has_some, "k", "left_semi")).withColumn("k", _key()).join(places, "k")
    whole = _packed(keyed.join(has_some, "k", "left_anti")).withColumn("places", F.lit(None).cast(places.schema["places"].dataType))
    rows = touched.select("doc_id", "z", "places").unionByName(whole.select("doc_id", "z", "places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out: list[list] = []
            size = at = 0
            for i, (z, p) in enumerate(zip(b.column(1), b.column(2).to_pylist(), strict=True)):
                raw = unpack.decompress(z.as_py())
                spans = gone = 0
                kept = raw
                if p:
                    flags = removed(p, len(raw), length)
                    gone = int(flags.sum())
                    spans = int((flags[1:] & ~flags[:-1]).sum()) + int(flags[0])
                    kept = np.frombuffer(raw, np.uint8)[~flags].tobytes()
                out.append([len(raw), gone, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])])
                size += len(raw)
                if size >= _OUT_BYTES or i == b.num_rows - 1:
                    arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds)]
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(at, len(out)), *arrays], names=names)
                    out, size, at = [], 0, i + 1

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *(["kept"] if with_text else [])]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return rows.mapInArrow(trimmed(run), schema + (", kept binary" if with_text else ""))
