"""Document quality learned from preference pairs (Bradley-Terry).

A document's score is linear in statistics of its text; of a document that
labels call good and one that they call bad, the good one is preferred with
probability 1 / (1 + exp(-(score difference))). The weights minimise that
logistic loss over feature differences. The threshold is a quantile of the
learning documents' scores: as large a share lies below it as labels call bad.

Spark makes the features of all documents in one pass. Every labelled learning
row teaches: rows of the two labels are dealt into blocks of bounded size by a
hash, a block of the commoner label meets one of the other, and its pairs are
all of their rows. With one block of each label these are all pairs there are.
Each step of the fit adds up sums of the blocks, of the size of the weights, and
the threshold is the exact quantile over all learning rows.

Defined results: null text is empty; an empty text has features (zeros) and a
score; a null id is held out or not by the check sum of an empty string, and
has no labels; an id with both labels teaches nothing; rows of one id and text
score alike; without labels of both kinds every score is 0.5; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopsight.llm import textops as X
from shopsight.llm.common import col, cut, map_rows, slices, small_side, text_bytes

#: Characters that end or split sentences, marks of emphasis, and
#: characters that prose hardly has.
STOPS, SHOUTS, SYMBOLS = b".,;:", b"!?", b"#$%&*|<>=+_~^@\\/{}[]"


@dataclass(frozen=True)
class Ranking:
    pairs: int = 250_000  # preference pairs of a block, about: 500 rows of each label
    ridge: float = 1e-3
    steps: int = 25
    cut: float = 0.7  # what the score is at the threshold


def _among(chars) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SETS = [_among(c) for c in (
    range(97, 123), range(65, 91), range(48, 58), STOPS, SHOUTS, SYMBOLS, X.WHITE.nonzero()[0], range(0xC0, 0x100))]
#: Of the search for the threshold: parts of a range, and scores that are few.
_PARTS, _FEW = 1024, 10_000
_MARKS = _among(SHOUTS + SYMBOLS)
_CAPITAL = _SETS[1]


def _repeats(key: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many keys of each row occurred in it before."""
    _, first = np.unique(X.mix(key ^ X.mix(rows.astype(X.U) + X.U(1))), return_index=True)
    return np.bincount(rows, minlength=n) - np.bincount(rows[first], minlength=n)


def features(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of statistics a text; shares are of its characters, words or lines."""
    n = len(off) - 1
    starts, ends, rows = X.word_spans(data, off)
    lead = X.per_row((data & 0xC0) != 0x80, off)
    words = np.bincount(rows, minlength=n)
    hashes = X.Hasher(data)
    key = hashes.of(starts, ends)
    size = (ends - starts).astype(float)
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] == key[:-1]) & (rows[1:] == rows[:-1])
    grams, at = X.shingles(key, rows, 3)
    breaks = np.flatnonzero(data == 10)
    line_at = np.unique(np.r_[off[:-1], breaks + 1])
    line_at = line_at[line_at < len(data)]
    line_to = np.minimum(np.r_[line_at[1:], len(data)], np.r_[breaks, len(data)][np.searchsorted(breaks, line_at)])
    line_row = np.searchsorted(off, line_at, "right") - 1
    lines = np.bincount(line_row, minlength=n)

    by_word = lambda x: np.bincount(rows, weights=x, minlength=n) / np.maximum(words, 1)
    last = data[ends - 1] if len(ends) else data[:0]
    head = data[starts] if len(starts) else data[:0]
    chars = np.maximum(lead, 1)
    return np.column_stack([
        np.log1p(words), np.log1p(lines), np.minimum(words, 50) / 50,
        *(X.per_row(s[data], off) / chars for s in _SETS),
        by_word(size), by_word(np.minimum(size * size, 1e4)) / 100,
        by_word(_MARKS[last]), by_word(_MARKS[head]), by_word(_CAPITAL[last]), by_word(size == 1), by_word(same),
        _repeats(key, rows, n) / np.maximum(words, 1),
        _repeats(grams, rows[at], n) / np.maximum(words, 1),
        _repeats(hashes.of(line_at, line_to), line_row, n) / np.maximum(lines, 1),
        words / np.maximum(lines, 1) / 100,
    ])


def with_features(docs: DataFrame, text: str, out: str) -> DataFrame:
    at = docs.columns.index(text)

    def arrays(b: pa.RecordBatch) -> list[pa.Array]:
        data, off = text_bytes(b.column(at))
        x = [features(data[off[i] : off[j]], off[i : j + 1] - off[i]) for i, j in slices(off)]
        x = np.concatenate(x) if x else np.zeros((0, 1))
        return [pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1], pa.array(x.ravel()))]

    return map_rows(docs, arrays, [T.StructField(out, T.ArrayType(T.DoubleType()))])


def raw_score(x: Column, weights: np.ndarray) -> Column:
    return F.aggregate(F.zip_with(x, F.array(*map(F.lit, weights.tolist())), lambda a, b: a * b),
                       F.lit(0.0), lambda s, y: s + y)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of the plain features
    threshold: float
    cut: float

    def score(self, x: Column) -> Column:
        """From 0 to 1, ``cut`` at the threshold."""
        if not self.weights.any():
            return F.lit(0.5)
        raw = raw_score(x, self.weights)
        base = float(np.log(self.cut / (1 - self.cut)))
        return 1 / (1 + F.exp(F.lit(self.threshold) - raw - F.lit(base)))


class Block:
    """Learning rows of both labels, each row so many times: every good one is
    preferred to every bad one. Sums over the pairs, without writing them out."""

    def __init__(self, good: np.ndarray, bad: np.ndarray, n_good: np.ndarray, n_bad: np.ndarray) -> None:
        self.good, self.bad, self.n_good, self.n_bad = good, bad, n_good, n_bad

    def steps(self, w: np.ndarray) -> np.ndarray:
        """Flat: the number of pairs, the slope and the curvature of the log-likelihood."""
        lead = (self.good @ w)[:, None] - (self.bad @ w)[None]
        p = 1 / (1 + np.exp(np.clip(lead, -30, 30)))
        times = self.n_good[:, None] * self.n_bad[None]
        q, p = times * p * (1 - p), times * p
        slope = p.sum(axis=1) @ self.good - p.sum(axis=0) @ self.bad
        both = (self.good.T @ q) @ self.bad
        bend = (self.good.T * q.sum(axis=1)) @ self.good + (self.bad.T * q.sum(axis=0)) @ self.bad - both - both.T
        return np.r_[times.sum(), slope, bend.ravel()]


def newton(steps: Callable[[np.ndarray], np.ndarray], width: int, rule: Ranking) -> np.ndarray:
    """The weights at which the ridged loss of the pairs is smallest; ``steps``
    gives ``Block.steps`` of all blocks together."""
    w = np.zeros(width)
    for _ in range(rule.steps):  # Newton's method; the loss is convex
        sums = steps(w)
        slope = sums[1 : 1 + width] / sums[0] - rule.ridge * w
        bend = sums[1 + width :].reshape(width, width) / sums[0] + rule.ridge * np.eye(width)
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _spread(both: np.ndarray) -> np.ndarray:
    """What the features are divided by; a constant tells nothing."""
    return np.where(both < 1e-9, np.inf, both)


def bradley_terry(good: np.ndarray, bad: np.ndarray, share_bad: float, rule: Ranking) -> Model:
    """``learn`` of rows at hand: the scores that prefer rows of ``good`` to rows of
    ``bad``; a share ``share_bad`` of the documents they stand for are bad."""
    width = good.shape[1] if good.ndim == 2 else bad.shape[1] if bad.ndim == 2 else 1
    if not len(good) or not len(bad):
        return Model(np.zeros(width), 0.0, rule.cut)
    spread = _spread(np.concatenate([good, bad]).std(axis=0))
    block = Block(good / spread, bad / spread, np.ones(len(good)), np.ones(len(bad)))
    w = newton(block.steps, width, rule) / spread
    # the quantile of all documents, each row standing for its share of its label
    scores = np.concatenate([good @ w, bad @ w])
    stands = np.r_[np.full(len(good), (1 - share_bad) / len(good)), np.full(len(bad), share_bad / len(bad))]
    order = np.argsort(scores, kind="stable")
    below = int(np.searchsorted(np.cumsum(stands[order]), share_bad - 1e-12)) + 1
    edge = scores[order[[below - 1, min(below, len(order) - 1)]]]
    return Model(w, float(edge.mean()), rule.cut)


def held_out(doc_id: Column, part: int = 2, parts: int = 4) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part


def _told(labels: DataFrame) -> DataFrame:
    """(doc_id, quality) of the learning labels, held-out rows left out."""
    told = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return told.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where(
        "quality = most").select("doc_id", F.col("quality").cast("int").alias("quality"))


_EXACT = "decimal(38,12)"  # a sum that doesn't depend on the order of its parts


def _blocks(rows: DataFrame, counts: dict[int, int], rule: Ranking) -> DataFrame:
    """(block, rows) of (quality, h, x, n): one row a block, which holds the rows
    of the commoner label once and those of the other one wherever they meet."""
    side = max(1, math.isqrt(rule.pairs))
    few, many = sorted((0, 1), key=lambda q: (counts[q], q))
    n_few, n_many = (-(-counts[q] // side) for q in (few, many))
    own = F.pmod("h", F.lit(n_few)).cast("long")
    # block b of the commoner label meets block b modulo n_few of the other one
    met = F.when(F.col("quality") == many, F.array(F.pmod("h", F.lit(n_many)).cast("long"))).otherwise(
        F.sequence(own, F.lit(n_many - 1).cast("long"), F.lit(n_few).cast("long")))

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by([("quality", "ascending"), ("h", "ascending")])
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)
        both = np.column_stack([t.column("quality").to_numpy(), t.column("n").to_numpy(), x])
        return pa.table({"block": t.column("block")[:1], "rows": pa.array([both.astype("<f8").tobytes()], pa.binary())})

    return rows.select(F.explode(met).alias("block"), "quality", "h", "x", "n").groupBy("block").applyInArrow(
        pack, "block long, rows binary").sortWithinPartitions("block")


def _sums(blocks: DataFrame, w: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """``Block.steps`` of all blocks together: a task gives a few hundred numbers,
    and one row of them comes back."""
    width = len(spread)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + width + width * width)
        for b in batches:
            for z in b.column(0):
                r = np.frombuffer(z.as_buffer(), "<f8").reshape(-1, 2 + width)
                good, n, x = r[:, 0] == 1, r[:, 1], r[:, 2:] / spread
                total += Block(x[good], x[~good], n[good], n[~good]).steps(w)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["at", "v"])

    found = blocks.select("rows").mapInArrow(run, "at long, v double").groupBy("at").agg(
        F.sum(F.col("v").cast(_EXACT)).cast("double").alias("v"))
    return found.orderBy("at").toArrow().column("v").to_numpy()


def _threshold(scores: DataFrame, stands: dict[int, float], share: float) -> float:
    """Half-way between the row of (quality, n, s) in ascending order at which the
    rows so far stand for ``share`` of the documents, and the row after it. The
    range that holds it is narrowed to few different scores, whatever the rows."""
    weight = {0: stands[0], 1: stands[1]}
    tally = [F.coalesce(F.sum(F.when(F.col("quality") == q, F.col("n"))), F.lit(0)).alias(f"n{q}") for q in (0, 1)]
    reached = lambda n0, n1: n0 * weight[0] + n1 * weight[1] >= share - 1e-12
    low, high, n_low = None, None, [0, 0]  # the row's score is above low, at most high
    while True:
        mine = scores
        if low is not None:
            mine = mine.where(F.col("s") > low)
        if high is not None:
            mine = mine.where(F.col("s") <= high)
        a, b, many = mine.agg(F.min("s"), F.max("s"), F.approx_count_distinct("s")).first()
        if many <= _FEW or not (b - a) / _PARTS > 0:
            break
        part = F.least(F.floor((F.col("s") - F.lit(a)) / F.lit((b - a) / _PARTS)), F.lit(_PARTS - 1))
        for r in sorted(mine.groupBy(part.alias("p")).agg(*tally, F.max("s").alias("top")).collect()):
            if reached(n_low[0] + r.n0, n_low[1] + r.n1):
                high = r.top
                break
            n_low, low = [n_low[0] + r.n0, n_low[1] + r.n1], r.top
    for r in sorted(mine.groupBy("s").agg(*tally).collect()):
        for q in (1, 0):
            n = r[f"n{q}"]
            before = n_low.copy()
            n_low[q] += n
            if reached(*n_low):
                # the row among those of this score and label; is it the last one of the score?
                left = math.ceil((share - 1e-12 - before[0] * weight[0] - before[1] * weight[1]) / weight[q] - 1e-9)
                last = max(left, 1) >= n and (q == 0 or r.n0 == 0)
                after = scores.where(F.col("s") > r.s).agg(F.min("s")).first()[0] if last else r.s
                return (r.s + (r.s if after is None else after)) / 2
    return float(scores.agg(F.max("s")).first()[0])


def learn(docs: DataFrame, labels: DataFrame, rule: Ranking = Ranking()) -> Model:
    """The model of (doc_id, h, x), features and a hash of the text, and
    (doc_id, quality), held-out rows left out."""
    told = cut(_told(labels))
    ids = {r.quality: r["count"] for r in told.groupBy("quality").count().collect()}
    # rows of one id and text are one row, so many times
    rows = docs.join(small_side(told), "doc_id").groupBy("doc_id", "h").agg(
        F.min("quality").alias("quality"), F.first("x").alias("x"), F.count(F.lit(1)).alias("n"))
    rows = cut(rows.select(F.xxhash64("doc_id", "h").alias("h"), "quality", "x", "n"))
    found = {r.quality: r for r in rows.groupBy("quality").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n")).collect()}
    if len(found) < 2:
        return Model(np.zeros(1), 0.0, rule.cut)
    width = len(rows.select("x").first().x)
    each = rows.select(F.posexplode("x").alias("at", "v"), "n")
    means = each.groupBy("at").agg((F.sum((F.col("v") * F.col("n")).cast(_EXACT)).cast("double") / F.sum("n")).alias("m"))
    apart = (F.col("v") - F.col("m")) * (F.col("v") - F.col("m")) * F.col("n")
    wide = each.join(F.broadcast(means), "at").groupBy("at").agg(F.sqrt(F.sum(apart.cast(_EXACT)).cast("double") / F.sum("n")).alias("v"))
    spread = _spread(np.array([r.v for r in wide.orderBy("at").collect()]))
    blocks = cut(_blocks(rows, {q: found[q].rows for q in (0, 1)}, rule))
    w = newton(lambda w: _sums(blocks, w, spread), width, rule) / spread
    share_bad = ids[0] / (ids[0] + ids[1])
    scores = cut(rows.select("quality", "n", raw_score(F.col("x"), w).alias("s")))
    edge = _threshold(scores, {0: share_bad / found[0].n, 1: (1 - share_bad) / found[1].n}, share_bad)
    return Model(w, edge, rule.cut)


def classify(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
             rule: Ranking = Ranking()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    plain = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    known = with_features(plain.withColumn("h", F.xxhash64("text")), "text", "x").select("doc_id", "h", "x")
    known = cut(known)  # the fit and the scores read it
    model = learn(known, labels.select("doc_id", "quality"), rule)
    return known.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("x")).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= rule.cut, 1).otherwise(0))
