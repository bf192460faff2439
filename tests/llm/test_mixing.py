import math
from collections import defaultdict

import pytest

from shopsight.llm import mixing
from shopsight.llm.mixing import Target


def totals(rows):
    per = defaultdict(lambda: [0, 0, 0])
    for r in rows:
        per[r.source][0] += 1
        per[r.source][1] += r.n_tokens
        per[r.source][2] += r.n_tokens * r.copies
    return per


@pytest.mark.parametrize("block", [3, 2000])
@pytest.mark.parametrize("target", [Target(), Target(None, 2.0), Target(2.0, None, 40_000), Target(None, 99.0)])
def test_quotas_are_met(spark, docs, target, block, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", block)
    rows = mixing.draw(docs.drop("n_words"), target).collect()
    assert len(rows) == docs.count()
    per = totals(rows)
    tokens = mixing.cut(docs.select(docs.doc_id.cast("string").alias("doc_id"), "source",
                                    mixing.words(docs.text).alias("n_tokens")))
    plan = {r.source: r for r in mixing.source_plan(tokens, target).collect()}
    longest = defaultdict(int)
    for r in rows:
        longest[r.source] = max(longest[r.source], r.n_tokens)
        assert plan[r.source].epochs <= r.copies <= plan[r.source].epochs + 1
    for source, (_, n, got) in per.items():
        if n:  # whole documents only, never over the quota, one document under it at most
            assert plan[source].quota - 2 * longest[source] < got <= plan[source].quota, source
    if target.budget_tokens is None:
        assert all(r.copies >= 1 for r in rows)
    if target.max_repetition:
        epochs = [p.quota / p.tokens for p in plan.values() if p.tokens]
        assert max(epochs) / min(epochs) <= target.max_repetition * 1.01


def test_entropy_is_bisected(spark):
    shares = spark.createDataFrame([(0.7,), (0.2,), (0.1,)], "share double")
    a = mixing.find_exponent(shares, Target(None, 1.4))
    w = [s**a for s in (0.7, 0.2, 0.1)]
    h = -sum(x / sum(w) * math.log2(x / sum(w)) for x in w)
    assert abs(h - 1.4) < 1e-4
    assert mixing.find_exponent(shares, Target(None, 0.5)) == 1.0
    assert mixing.find_exponent(shares, Target(None, 5.0)) == 0.0


def test_mix_repeats_rows(spark, docs):
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    drawn = mixing.draw(docs.drop("n_words")).groupBy().sum("copies").first()[0]
    assert mixed.count() == drawn
    assert mixing.mix(docs.limit(0)).count() == 0
