import itertools
import re

import pytest

from shopsight.llm import jaccard
from shopsight.llm.components import components


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def brute(rows, n, percent):
    sets = [shingles(t, n) for _, t in rows]
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            label[find(j)] = find(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
                  key=str)


@pytest.mark.parametrize("rule", [jaccard.Join(), jaccard.Join(group=3, queries=2, count_cells=64),
                                  jaccard.Join(shingle=5, percent=80)])
def test_components_equal_brute_force(spark, corpus, rule):
    """A chain of edits, too, so that components are larger than neighbourhoods."""
    words = [f"c{i}" for i in range(120)]
    chain = [(500 + k, " ".join(words[3 * k : 3 * k + 90])) for k in range(10)]
    rows = [(i, t) for i, t, *_ in corpus if i != 135] + chain + [(600, "UPPER Case of One two"), (601, "upper case OF one TWO")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((tuple(r) for r in jaccard.linked(df, rule=rule).collect()), key=str)
    assert got == brute(rows, rule.shingle, rule.percent)


def test_keep_one(spark, docs, corpus):
    rule = jaccard.Join(shingle=5, percent=80)
    kept = jaccard.keep_one(docs, rule=rule)
    assert kept.columns == docs.columns
    want = {c for d, n, c in brute([(i, t) for i, t, *_ in corpus], 5, 80) if n}
    got = [r.doc_id for r in kept.collect() if shingles(r.text, 5)]
    assert sorted(got) == sorted(want)
    assert sum(not shingles(r.text, 5) for r in kept.collect()) == sum(not shingles(t, 5) for _, t, *_ in corpus)
    assert jaccard.keep_one(docs.limit(0)).count() == 0
    assert jaccard.linked(docs.limit(0)).count() == 0


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(1000, 1001), (1001, 1001), (1001, 1000)], "a long, b long")
    got = {r.node: r.label for r in components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, 1000: 1000, 1001: 1000}
