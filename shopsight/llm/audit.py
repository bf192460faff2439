"""How filters of a pipeline interact, in every order.

Each document gets one failure mark a filter. Spark counts the documents (and
those that labels call good or toxic) of each part and each combination of
marks: 32 cells a part, whatever its size. A part's cells, reshaped to
2x2x2x2x2, are its contingency tensor; one ``einsum`` contracts it, for every
step of every order, along each axis with a vector that selects the documents
that pass, that fail, or all of them.

The last filter marks copies: a text that a smaller id has, too. Texts are
compared by their SHA-256. A text that makes a thousandth of all rows or more
(there are at most a thousand such texts) is looked up in a broadcast, so that
a large group of copies is never one task's.

Defined results: null text is empty, a null part is the empty string; a null id
has no smaller one, is smaller than none, and has no label; rows of one id and
text are no copies of each other; a document is good (toxic) if any label row
of its id says so; rows of one id count each; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopsight.llm.common import col, cut

FILTERS = "ABCDE"
MEASURES = ("n", "good", "toxic")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
_CELLS = 1 << len(FILTERS)
_PARTS = 32  # tensors contracted at a time
_HOT_SHARE = 1000


@dataclass(frozen=True)
class Limits:
    min_words: int = 50
    min_distinct_percent: int = 65
    max_capital_percent: int = 5


def failures(text: Column, rule: Limits = Limits()) -> Column:
    """The filters A to D that a text fails, as the low bits of a number."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = (
        n < rule.min_words,
        100 * distinct < rule.min_distinct_percent * n,
        100 * capitals > rule.max_capital_percent * F.length(text),
        text.rlike(r"[#$%&*|]"),
    )
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))


def _with_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, part, code) with the copies' bit; ``docs`` is kept and narrow."""
    firsts = docs.groupBy("h").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 and first is not null")
    n_rows = docs.count()
    hot = F.broadcast(cut(firsts.where(F.col("n") * _HOT_SHARE >= n_rows)).select("h", "first"))
    often = docs.join(hot, "h")
    seldom = docs.join(hot, "h", "left_anti").join(firsts.where(F.col("n") * _HOT_SHARE < n_rows), "h", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    code = F.col("code") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    return often.select("doc_id", "part", code.alias("code")).unionByName(
        seldom.select("doc_id", "part", code.alias("code")))


def cells(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source",
          rule: Limits = Limits()) -> DataFrame:
    """(part, code, n, good, toxic): how many documents of a part fail exactly
    the filters whose bits ``code`` has."""
    t = F.coalesce(col(text).cast("string"), F.lit(""))
    marked = cut(docs.select(
        col(doc_id).cast("long").alias("doc_id"), F.coalesce(col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(t.cast("binary"), 256)).alias("h"), failures(t, rule).alias("code")))
    # rows of one id are few after this, however often it occurs
    per_id = _with_copies(marked).groupBy("doc_id", "part", "code").agg(F.count(F.lit(1)).alias("n"))
    told = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    lost = lambda flag: F.sum(F.when(F.col(flag) == 1, F.col("n")).otherwise(0)).alias(flag)
    return per_id.join(told, "doc_id", "left").groupBy("part", "code").agg(lost("good"), lost("toxic"), F.sum("n").alias("n"))


def steps() -> tuple[list[str], np.ndarray, np.ndarray]:
    """The orders; the filter of each (order, step); and which filters came
    before it."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    filters = np.array([[FILTERS.index(f) for f in o] for o in orders])
    before = np.zeros((len(orders), len(FILTERS), len(FILTERS)), bool)
    for s in range(1, len(FILTERS)):
        before[:, s] = before[:, s - 1]
        before[np.arange(len(orders)), s, filters[:, s - 1]] = True
    return orders, filters.ravel(), before.reshape(-1, len(FILTERS))


def contract(tensors: np.ndarray) -> np.ndarray:
    """(parts, steps, counts) of tensors (parts, measures, 2, 2, 2, 2, 2), whose
    axes are the filters and whose places are pass and fail."""
    _, filters, before = steps()
    at = np.arange(len(filters))
    passes, fails, every = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])

    def select(own: np.ndarray, earlier: np.ndarray, others: np.ndarray) -> np.ndarray:
        """The contraction of each step, with a vector for each kind of axis."""
        vectors = np.where(before[:, :, None], earlier, others)
        vectors[at, filters] = own
        axes = "abcde"
        return np.einsum(f"pm{axes}," + ",".join(f"s{a}" for a in axes) + "->psm", tensors,
                         *(vectors[:, k] for k in range(len(axes))), optimize=True)

    removed = select(fails, passes, every)
    failing = select(fails, every, every)[..., 0]
    n_removed = removed[..., 0]
    total = np.zeros((len(tensors), len(FILTERS)), np.int64)
    np.add.at(total.T, filters, n_removed.T)
    return np.stack([
        select(passes, passes, every)[..., 0], n_removed, failing - n_removed, select(fails, passes, passes)[..., 0],
        removed[..., 1], removed[..., 2], total[:, filters]], axis=-1)


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", part: str = "source",
          rule: Limits = Limits()) -> DataFrame:
    """One row for each part, order of the filters and step of it."""
    orders, filters, _ = steps()
    n_steps = len(filters)
    tensors = cells(docs, labels, text, doc_id, part, rule).groupBy("part").agg(
        F.collect_list(F.struct("code", *MEASURES)).alias("cells"))  # 32 at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _PARTS):
                b = whole.slice(at, _PARTS)
                given = b.column(1)
                found, owner = given.flatten(), np.repeat(np.arange(b.num_rows), given.value_lengths())
                counts = np.zeros((b.num_rows, len(MEASURES), _CELLS), np.int64)
                for k, m in enumerate(MEASURES):
                    counts[owner, k, found.field("code").to_numpy()] = found.field(m).to_numpy()
                # the last bit is the first axis of the reshaped cells
                axes = counts.reshape(b.num_rows, len(MEASURES), *(2 for _ in FILTERS))
                axes = axes.transpose(0, 1, *range(axes.ndim - 1, 1, -1))
                out = contract(axes).reshape(b.num_rows * n_steps, len(COUNTS))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), n_steps))),
                    pa.array([o for o in orders for _ in FILTERS] * b.num_rows),
                    pa.array(np.tile(np.arange(n_steps, dtype=np.int32) % len(FILTERS) + 1, b.num_rows)),
                    *(pa.array(np.ascontiguousarray(out[:, k])) for k in range(len(COUNTS)))],
                    names=["part", "filter_order", "step", *COUNTS])

    return tensors.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
