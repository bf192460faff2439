"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens to the power of an exponent, made
to sum to 1. The exponent is bisected until the weights have a target entropy,
or until no source is repeated more than a limit as often as another. The
weights are realised under a token budget: every source gives whole random
permutations of its documents (epochs) and, for what is left, the first
documents of one more permutation. A permutation comes in blocks of the hash
range: sums of blocks show which blocks fit, and only the block on the edge of
the budget is looked into, so a source of any size is never sorted as a whole.

Defined results: a null source is a source of its own; a document without
tokens weighs nothing and comes once an epoch; a source without tokens gets no
quota and its documents come once; equal rows are drawn each by itself;
an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopsight.llm.common import col, cut, fresh, small_side

#: Levels of bisection that one pass over the source totals settles: all
#: midpoints that these levels can reach are measured at once.
LEVELS = 6
PASSES = 4
BLOCK_DOCS = 2_000


@dataclass(frozen=True)
class Target:
    """Give one of the first two. ``budget_tokens``: in all; None: as many as
    give the least repeated source one epoch, so that no document is left out."""

    max_repetition: float | None = 1.5
    entropy_bits: float | None = None
    budget_tokens: int | None = None
    seed: int = 17


def words(text: Column) -> Column:
    """The number of words, taken for tokens."""
    bare = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))
    return F.when(bare == "", 0).otherwise(F.length(bare) - F.length(F.translate(bare, " ", "")) + 1).cast("long")


def find_exponent(totals: DataFrame, target: Target) -> float:
    """The exponent in [0, 1], to 2**-24, that is nearest to 1 (the sources'
    own shares) and meets the target; 0 (equal weights) if none does.
    ``totals``: rows of source and share."""
    low, high = 0.0, 1.0
    real = totals.where(F.col("share") > 0)
    for _ in range(PASSES):
        n = 1 << LEVELS
        grid = [low + (high - low) * k / n for k in range(n + 1)]
        rows = real.select("share", F.posexplode(F.array(*map(F.lit, grid))).alias("k", "a"))
        if target.max_repetition is not None:
            epochs = F.pow("share", F.col("a") - 1)
            measured = rows.groupBy("k").agg((F.max(epochs) / F.min(epochs)).alias("m"))
            ok = {r.k: r.m <= target.max_repetition for r in measured.collect()}
        else:
            power = F.pow("share", F.col("a"))
            z, zl = F.sum(power), F.sum(power * F.col("a") * F.log2("share"))
            measured = rows.groupBy("k").agg((F.log2(z) - zl / z).alias("m"))
            ok = {r.k: r.m >= target.entropy_bits for r in measured.collect()}
        # repetition falls and entropy falls as the exponent rises
        rising = target.max_repetition is not None
        if not ok or (not rising and ok[n]):
            return high
        if not rising and not ok[0]:
            return low
        if rising and ok[0]:
            return low
        a, b = 0, n
        while b - a > 1:
            mid = (a + b) // 2
            a, b = (a, mid) if ok[mid] == rising else (mid, b)
        low, high = grid[a], grid[b]
    return high if target.max_repetition is not None else low


def source_plan(tokens: DataFrame, target: Target) -> DataFrame:
    """One row a source: docs, tokens, weight, quota, whole epochs, rest."""
    t = cut(tokens.groupBy("source").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens")))
    whole = t.agg(F.sum("tokens").alias("n")).first().n or 0
    t = t.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1))))
    exponent = find_exponent(t, target)
    t = t.withColumn("power", F.when(F.col("tokens") > 0, F.pow("share", F.lit(exponent))).otherwise(0.0))
    norm = t.agg(F.sum("power").alias("z"),
                 F.max(F.when(F.col("tokens") > 0, F.col("tokens") / F.col("power"))).alias("top")).first()
    z, top = float(norm.z or 1.0), float(norm.top or 0.0)
    t = t.withColumn("weight", F.col("power") / F.lit(z))
    budget = float(target.budget_tokens) if target.budget_tokens is not None else top * z
    # quotas that should be whole numbers are off by a few ulps
    quota = F.floor(F.col("weight") * F.lit(budget * (1 + 1e-12)) + F.lit(1e-6)).cast("long")
    real = F.col("tokens") > 0
    return t.withColumn("quota", quota).select(
        "source", "docs", "tokens", "weight", "quota",
        F.when(real, F.expr("quota div tokens")).otherwise(1).cast("long").alias("epochs"),
        F.when(real, F.expr("quota % tokens")).otherwise(0).cast("long").alias("rest"))


def _place(doc_id: Column, n_tokens: Column, seed: int) -> Column:
    """A document's place in the permutation of its source."""
    return F.xxhash64(F.lit(seed), doc_id.cast("string"), n_tokens)


def _block(place: Column, blocks: Column) -> Column:
    """The block of the hash range that a place lies in."""
    return F.floor(F.shiftrightunsigned(place, 33).cast("double") / F.lit(float(1 << 31)) * blocks).cast("long")


def permutation_edges(tokens: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """``plan`` with what the partial permutation takes: all blocks before
    ``edge``, and of that block the places up to ``last``."""
    named = F.struct("source").alias("s")  # structs join null sources, too
    plan = plan.withColumn("s", F.struct("source")).withColumn(
        "blocks", F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)).cast("long"))
    places = tokens.select(named, "n_tokens", _place(F.col("doc_id"), F.col("n_tokens"), seed).alias("place"))
    plan = cut(plan)
    places = places.join(small_side(plan.select("s", "blocks")), "s").withColumn("block", _block(F.col("place"), F.col("blocks")))
    sums = places.groupBy("s", "block").agg(F.sum("n_tokens").alias("sum"))
    upto = Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("upto", F.sum("sum").over(upto)).join(plan.select("s", "rest"), "s")
    edges = sums.where(F.col("upto") > F.col("rest")).groupBy("s").agg(
        F.min(F.struct("block", "upto", "sum", "rest")).alias("e")
    ).select("s", F.col("e.block").alias("edge"), (F.col("e.rest") - F.col("e.upto") + F.col("e.sum")).alias("room"))
    inside = places.join(edges.withColumnRenamed("edge", "block"), ["s", "block"])
    running = F.sum("n_tokens").over(Window.partitionBy("s").orderBy("place"))  # equal places count together
    last = inside.withColumn("running", running).where(F.col("running") <= F.col("room")).groupBy("s").agg(
        F.max("place").alias("last"))
    return plan.join(edges.select("s", "edge"), "s", "left").join(last, "s", "left")


def draw(docs: DataFrame, target: Target = Target(), text: str = "text", source: str = "source",
         doc_id: str = "doc_id", n_tokens: str = "n_tokens", copies: str = "copies") -> DataFrame:
    """``docs`` and two columns: its tokens and how often the mixture has it.

    The texts are not shuffled unless the plan of the sources is too large for
    Spark to broadcast.
    """
    size = words(col(text).cast("string"))
    tokens = cut(docs.select(col(doc_id).cast("string").alias("doc_id"),
                             col(source).cast("string").alias("source"), size.alias("n_tokens")))
    edges = small_side(cut(permutation_edges(tokens, source_plan(tokens, target), target.seed)).select(
        F.col("s").alias("__s"), "epochs", "rest", "blocks", "edge", "last"))
    rows = docs.withColumn(n_tokens, size).withColumn("__s", F.struct(col(source).cast("string").alias("source")))
    rows = rows.join(edges, "__s", "left").withColumn("__place", _place(col(doc_id), F.col(n_tokens), target.seed))
    block = _block(F.col("__place"), F.col("blocks"))
    inside = (block < F.col("edge")) | ((block == F.col("edge")) & (F.col("__place") <= F.col("last")))
    taken = F.when((F.col("rest") > 0) & F.coalesce(inside, F.lit(False)), 1).otherwise(0)
    return rows.withColumn(copies, F.col("epochs") + taken).select(*(col(c) for c in docs.columns), n_tokens, copies)


def mix(docs: DataFrame, target: Target = Target(), text: str = "text", source: str = "source",
        doc_id: str = "doc_id") -> DataFrame:
    """The mixture itself: the rows of ``docs``, each as often as it is drawn."""
    size, copies = fresh(docs, "n_tokens"), fresh(docs, "copies")
    drawn = draw(docs, target, text, source, doc_id, size, copies)
    return drawn.withColumn(size, F.explode(F.sequence(F.lit(1), F.col(copies)))).where(
        F.col(copies) > 0).select(*(col(c) for c in docs.columns))
