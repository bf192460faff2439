"""Nearest neighbours by shifted space-filling curves.

Each curve projects the vectors onto a few random directions, shifts them and
orders them along a Hilbert curve. A curve's order is dealt into key ranges;
a query looks through its own range and the neighbouring ones, and the best
finds of all curves are merged. Scores are exact inner products in double
precision, so only the choice of candidates is approximate.

Equal vectors are one class: its representative (the smallest id) is indexed and
asked once, and the smallest ids of the classes that a query finds take their
places afterwards, so a vector of any number of rows shows its smallest ids.

For the largest inner product, vectors get one more coordinate that makes all
of them equally long, which turns it into the smallest distance.

The windows are a share of the table (``(2 * near + 1) / blocks``). Isotropic
vectors, which have no neighbourhoods that a curve could keep, need a wide one
for a recall of 0.9; vectors with structure do with more blocks.

Defined results: vectors that are null, zero, of another length than most, or
hold null or non-finite components take no part; equal vectors are ordered by
id; rows with a null id take no part; equal rows of one id count once as a
find; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm import textops as X
from shopsight.llm.common import col, cut, small_side
from shopsight.llm.hilbert import positions


@dataclass(frozen=True)
class Curves:
    curves: int = 14
    axes: int = 8
    bits: int = 6
    blocks: int = 24
    near: int = 1
    k: int = 20
    sample: int = 20_000  # vectors that the ranges are fitted on; all are indexed
    members: int = 8192  # of a range in one task
    queries: int = 2048
    seed: int = 5


_TIE_BITS = 14


def _matrix(column: pa.Array, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Valid vectors as rows, and their places in the column."""
    values = column.to_pylist() if column.null_count or width is None else None
    if values is None:
        sizes = np.diff(column.offsets.to_numpy())
        flat = column.flatten()
        if (sizes == width).all() and flat.null_count == 0:
            m = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            at = np.arange(len(m))
            good = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
            return m[good], at[good]
        values = column.to_pylist()
    at = [i for i, v in enumerate(values) if v and (width is None or len(v) == width) and None not in v]
    if width is None:
        return np.zeros((0, 0)), np.array([len(values[i]) for i in at], np.int64)
    m = np.array([values[i] for i in at], np.float64).reshape(-1, width)
    good = np.isfinite(m).all(axis=1) & (m != 0).any(axis=1)
    return m[good], np.array(at, np.int64)[good]


class Index:
    """Projections, scales and key ranges of all curves, from a sample."""

    def __init__(self, sample: np.ndarray, ids: np.ndarray, longest: float, rule: Curves) -> None:
        self.rule, self.longest = rule, longest
        self.width = sample.shape[1]
        whole = self._lift(sample)
        self.axes, self.mean, self.scale, self.shift, self.edges = [], [], [], [], []
        for c in range(rule.curves):
            r = np.random.default_rng([rule.seed, c])
            q, _ = np.linalg.qr(r.normal(size=(whole.shape[1], min(rule.axes, whole.shape[1]))))
            z = whole @ q
            self.axes.append(q)
            self.mean.append(z.mean(axis=0))
            self.scale.append(np.maximum(z.std(axis=0), 1e-12))
            self.shift.append(r.uniform(size=q.shape[1]))
            keys = np.sort(self._key(c, whole, ids))
            cuts = (np.arange(1, rule.blocks) * len(keys)) // rule.blocks
            self.edges.append(keys[cuts])

    def _lift(self, m: np.ndarray) -> np.ndarray:
        rest = np.maximum(self.longest**2 - (m**2).sum(axis=1), 0.0)
        return np.c_[m, np.sqrt(rest)]

    def _key(self, c: int, whole: np.ndarray, ids: np.ndarray) -> np.ndarray:
        z = (whole @ self.axes[c] - self.mean[c]) / self.scale[c]
        even = 1 / (1 + np.exp(-1.702 * z))  # about the normal distribution's
        cells = ((even + self.shift[c]) / 2 * (1 << self.rule.bits)).astype(np.int64)
        tie = (X.mix(ids.astype(X.U)) >> X.U(64 - _TIE_BITS)).astype(np.int64)
        return (positions(np.minimum(cells, (1 << self.rule.bits) - 1), self.rule.bits) << _TIE_BITS) | tie

    def blocks(self, c: int, m: np.ndarray, ids: np.ndarray, query: bool = False) -> np.ndarray:
        whole = np.c_[m, np.zeros(len(m))] * (self.longest / np.linalg.norm(m, axis=1))[:, None] if query else self._lift(m)
        return np.searchsorted(self.edges[c], self._key(c, whole, ids), "right")


def _scan(vectors: DataFrame, rule: Curves) -> tuple[int, float]:
    """The usual length of a vector and the largest norm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        widths: Counter[int] = Counter()
        norms: dict[int, float] = {}
        for b in batches:
            lengths = _matrix(b.column(1))[1]
            for w in set(lengths.tolist()):
                widths[w] += int((lengths == w).sum())
                m, _ = _matrix(b.column(1), w)
                if len(m):
                    norms[w] = max(norms.get(w, 0.0), float(np.sqrt((m**2).sum(axis=1).max())))
        yield pa.RecordBatch.from_pydict({"w": list(widths), "n": [widths[w] for w in widths],
                                          "m": [norms.get(w, 0.0) for w in widths]},
                                         schema=pa.schema([("w", pa.int64()), ("n", pa.int64()), ("m", pa.float64())]))

    top = vectors.mapInArrow(run, "w long, n long, m double").groupBy("w").agg(
        F.sum("n").alias("n"), F.max("m").alias("m")).orderBy(F.desc("n"), "w").limit(1).collect()
    return (top[0].w, top[0].m) if top else (0, 0.0)


_OUT = "asker long, cls long, vec_id long, score double"


def _valid(v: Column, width: int) -> Column:
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return (F.size(v) == width) & ~F.exists(v, odd) & F.exists(v, lambda x: x != 0)


def _classes(rows: DataFrame, every: int, k: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of (cls, vec_id, v): the representatives (cls, vec_id, v, ask), the
    queries (cls, query_id) and the smallest ids (cls, ids) of larger classes."""
    ids = cut(rows.select("cls", "vec_id").distinct())
    ask = F.col("vec_id") % every == 0
    many = cut(ids.groupBy("cls").agg(F.min("vec_id").alias("least"), F.max(ask).alias("asks"),
                                      F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    shared = small_side(many)
    one = rows.join(shared, "cls", "left").where("least is null or least = vec_id").select(
        "cls", "vec_id", "v", F.coalesce("asks", ask).alias("ask"))
    order = Window.partitionBy("cls").orderBy("vec_id")  # its limit is taken before the shuffle, too
    least = ids.join(shared.select("cls"), "cls", "left_semi").withColumn("at", F.row_number().over(order)).where(
        F.col("at") <= k + 1).groupBy("cls").agg(F.collect_list("vec_id").alias("ids"))
    return one, ids.where(ask).select("cls", F.col("vec_id").alias("query_id")), least


def search(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = 20,
           rule: Curves = Curves()) -> DataFrame:
    """The ``k`` nearest finds of each query (ids divisible by ``every``) among
    all other rows: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    plain = vectors.select(col(vec_id).cast("long").alias("vec_id"),
                           col(embedding).cast("array<double>").alias("v")).where("vec_id is not null")
    width, longest = _scan(plain, rule)
    rows = plain.where(_valid(F.col("v"), width)).withColumn("cls", F.xxhash64(F.transform("v", lambda x: x + 0.0)))  # -0.0 is 0.0
    one, asked, least = _classes(rows, every, rule.k)
    taken = one.orderBy(F.xxhash64("vec_id"), "vec_id").limit(rule.sample).select("vec_id", "v").toArrow() if width else None
    sample, at = _matrix(taken.column("v").combine_chunks(), width) if width else (np.zeros((0, 0)), None)
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = one.count()
    # a range holds a few times k vectors at least, so that a short table is searched whole
    rule = replace(rule, blocks=min(rule.blocks, max(1, n // (4 * rule.k))))
    index = spark.sparkContext.broadcast(
        Index(sample, taken.column("vec_id").to_numpy()[at], longest, rule))
    member_parts = max(1, -(-n // (rule.blocks * rule.members)))
    query_parts = max(1, -(-n * (2 * rule.near + 1) // (every * rule.blocks * rule.queries)))

    def deal(query: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ix = index.value
            for b in batches:
                ids = b.column(0).to_numpy()
                m, at = _matrix(b.column(1), ix.width)
                ids, classes = ids[at], b.column(2).to_numpy()[at]
                salt = (X.mix(ids.astype(X.U)) >> X.U(8)).astype(np.int64)
                for c in range(rule.curves) if len(ids) else ():
                    block = ix.blocks(c, m, ids, query)
                    for step in range(-rule.near, rule.near + 1) if query else (0,):
                        near = block + step
                        ok = (near >= 0) & (near < rule.blocks)
                        own = salt % (query_parts if query else member_parts)
                        for other in range(member_parts if query else query_parts):
                            size = int(ok.sum())
                            both = np.full(size, other)
                            flat = pa.array(m[ok].ravel())
                            yield pa.RecordBatch.from_arrays([
                                pa.array(np.full(size, c)), pa.array(near[ok]),
                                pa.array(both if query else own[ok]), pa.array(own[ok] if query else both),
                                pa.array(ids[ok]), pa.array(classes[ok]),
                                pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * ix.width, pa.int32()), flat),
                            ], names=["curve", "block", "part", "turn", "id", "cls", "v"])
        source = (one.where("ask") if query else one).select("vec_id", "v", "cls")
        return source.mapInArrow(run, "curve long, block long, part long, turn long, id long, cls long, v array<double>")

    def meet(members: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], [], []]
        if members.num_rows and queries.num_rows:
            ids, classes, m = members.column("id").to_numpy(), members.column("cls").to_numpy(), _stack(members.column("v"))
            wanted = rule.k + 1  # one of them may be the query
            for q, v in zip(queries.column("cls").to_numpy(), _stack(queries.column("v")), strict=True):
                rough = m @ v
                some = np.arange(len(ids))
                if len(some) > wanted:
                    edge = np.partition(rough, len(some) - wanted)[len(some) - wanted]
                    some = np.flatnonzero(rough >= edge - 1e-9 * max(1.0, abs(edge)))
                exact = (m[some] * v).sum(axis=1)  # the same for equal vectors, wherever they are
                best = np.lexsort((ids[some], -exact))[:wanted]
                out[0].append(np.full(len(best), q))
                out[1].append(classes[some][best])
                out[2].append(ids[some][best])
                out[3].append(exact[best])
        cat = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"asker": pa.array(cat[0], pa.int64()), "cls": pa.array(cat[1], pa.int64()),
                         "vec_id": pa.array(cat[2], pa.int64()), "score": pa.array(cat[3], pa.float64())})

    key = ("curve", "block", "part", "turn")
    found = deal(False).groupBy(*key).cogroup(deal(True).groupBy(*key)).applyInArrow(meet, _OUT)

    def best(df: DataFrame) -> DataFrame:
        """The k + 1 best of each class that asks."""
        order = Window.partitionBy("asker").orderBy(F.desc("score"), "vec_id")
        return df.withColumn("at", F.row_number().over(order)).where(F.col("at") <= rule.k + 1).drop("at")

    # one find of a class by several curves counts once; its score is the same
    once = best(found.groupBy("asker", "cls", "vec_id").agg(F.max("score").alias("score")))
    single = once.join(least, "cls", "left").select(
        "asker", "score", F.explode(F.coalesce("ids", F.array("vec_id"))).alias("vec_id"))
    lists = best(single.groupBy("asker", "vec_id").agg(F.max("score").alias("score"))).groupBy(
        F.col("asker").alias("cls")).agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("finds"))
    others = F.slice(F.filter("finds", lambda x: x.vec_id != F.col("query_id")), 1, rule.k)
    return asked.join(lists, "cls").select("query_id", F.posexplode(others).alias("at", "find")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "find.vec_id", (-F.col("find.s")).alias("score"))


def _stack(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = flat.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(flat), -1)
