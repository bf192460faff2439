import re
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from shopsight.llm import audit

WORD = re.compile("[^\x20\x09-\x0D]+")


def fails(rows):
    """(part, letters failed, doc_id) of (doc_id, text, part)."""
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, s in rows:
        t = t or ""
        w = WORD.findall(t)
        yield s or "", "".join(k for k, bad in (
            ("A", len(w) < 50), ("B", 100 * len(set(w)) < 65 * len(w)), ("C", 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t)),
            ("D", any(c in "#$%&*|" for c in t)), ("E", i is not None and i > first[t])) if bad), i


def brute(rows, labels):
    """Every order run step by step over the documents themselves."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = {}
    for part, letters, i in fails(rows):
        parts.setdefault(part, []).append((letters, i))
    out = []
    for part, docs in parts.items():
        lines, shapley = [], Counter()
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), sum(f in d[0] for d in docs) - len(gone),
                              sum(d[0] == f for d in docs), sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone)))
        out += [(*x, shapley[x[1][x[2] - 1]]) for x in lines]
    return Counter(out)


@pytest.fixture(scope="module")
def labelled():
    return [(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(0, 140, 2)] + [
        (None, 1, 1), (4, 1, None), (4, 0, 1), (133, 1, 1), (9999, 1, 1)]


@pytest.mark.parametrize("hot", [1, 5, 1000])
def test_equals_a_run_of_every_order(spark, docs, corpus, labelled, hot, monkeypatch):
    """``hot``: texts of all rows, of a fifth and of a thousandth are broadcast."""
    monkeypatch.setattr(audit, "_HOT_SHARE", hot)
    marks = [(200, "SHOUT " * 60, "en", "s0"), (201, "#1 " + "word " * 70, "en", "s1"), (5, "SHOUT " * 60, "en", "hot"),
             (199, "", "en", ""), (198, "A" * 3 + "b" * 57, "en", "s2")]
    rows = [*corpus, *marks]
    extra = spark.createDataFrame([(*r, 7, "x", [1], 0.5) for r in marks], docs.schema)
    told = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    got = audit.audit(docs.unionByName(extra), told)
    assert got.columns == ["part", "filter_order", "step", *audit.COUNTS]
    assert Counter(tuple(r) for r in got.collect()) == brute([(i, t, s) for i, t, _, s in rows], labelled)


def test_empty_tables(spark, docs, labelled):
    told = spark.createDataFrame(labelled, "doc_id long, quality int, toxic int")
    assert audit.audit(docs.limit(0), told).count() == 0
    rows = audit.audit(docs, told.limit(0)).collect()
    assert rows and all(r.good_lost == r.toxic_lost == 0 for r in rows)


def test_contraction_of_one_cell():
    tensor = np.zeros((1, 3, 2, 2, 2, 2, 2), np.int64)
    tensor[0, :, 1, 0, 1, 0, 0] = (7, 3, 2)  # seven fail A and C
    orders, filters, _ = audit.steps()
    got = {(orders[k // 5], k % 5 + 1): dict(zip(audit.COUNTS, x)) for k, x in enumerate(audit.contract(tensor)[0].tolist())}
    assert got["ABCDE", 1] == dict(kept=0, removed=7, redundant=0, unique_fails=0, good_lost=3, toxic_lost=2, shapley=420)
    assert got["ABCDE", 3] == dict(kept=0, removed=0, redundant=7, unique_fails=0, good_lost=0, toxic_lost=0, shapley=420)
    assert got["BDCAE", 3]["removed"] == 7 and got["BDCAE", 2]["kept"] == 7
