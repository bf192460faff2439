import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from shopsight.llm import phrases
from shopsight.llm.common import bit_table, in_table
from shopsight.llm.phrases import Mining


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(rows, rule):
    """Every phrase of every piece counted by itself; ``rows`` are (text, lang)."""
    f, n = defaultdict(Counter), Counter()
    for t, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower(t)):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, rule.longest + 1) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        often = {p: a for p, a in c.items() if a >= rule.least}
        rows = []
        for p, a in often.items():
            if len(p) < 2 or any(
                    len(q) > len(p) and 100 * b >= rule.inside_percent * a
                    and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in often.items()):
                continue
            score, _, left, right = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((" ".join(p), a, left, right, n[lang], score))
        rows.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, k, *r) for k, r in enumerate(rows[: rule.top], 1)]
    return sorted(out)


def mined(df, rule, **kw):
    got = phrases.collocations(df, rule=rule, **kw)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


PASSAGES = [
    ("New York City is big. new york city, NEW YORK", "en"), ("a\tb  a b a b a b\x0ba b", "en"), ("of the the the of the the", None),
    ("of the; of the: of the! of the?", "und"), ("Ärger im Öl Ärger im Öl Ärger im Öl", "de"), ("ÄRGER im Öl", "de"), ("x" * 3000, "de"),
    ("one", ""), ("", "fr"), (None, "fr"), (None, None), (" \t\n", "en"), ("a.b a.b a.b a.b", "en"), ("p q r s t u v w " * 5, "es"),
]


@pytest.mark.parametrize("rule", [
    Mining(least=3), Mining(least=2, longest=3, top=7), Mining(least=5, inside_percent=60, filtered=5),
    Mining(least=1, top=40, filtered=1), Mining(least=4, longest=2, filtered=2)])
def test_equals_brute_force(spark, docs, corpus, rule, monkeypatch):
    monkeypatch.setattr(phrases, "_ROWS", 500)  # several sums a task
    monkeypatch.setattr(phrases, "_PLACES", 99)
    monkeypatch.setattr(phrases, "_KEYS", 300)
    monkeypatch.setattr(phrases, "_RANKED", 50)  # languages ordered in parts
    more = spark.createDataFrame([(1, t, lang, None, 7, "x", [1], 0.5) for t, lang in PASSAGES * 3], docs.schema)
    short = [(t, lang) for _, t, lang, _ in corpus if len(t or "") < 20_000]
    few = docs.where("text is null or length(text) < 20000").unionByName(more)
    want = brute(short + PASSAGES * 3, rule)
    assert want and mined(few, rule) == want


def test_a_full_table_changes_nothing(spark, docs, monkeypatch):
    """Where every word and pair may be frequent, only time is lost."""
    few = docs.where("length(text) < 5000")
    plain = mined(few, Mining(least=4))
    monkeypatch.setattr(phrases, "in_table", lambda table, key: np.ones(len(key), bool))
    assert mined(few, Mining(least=4)) == plain


def test_packed_counts():
    keys = np.array([0, 1, 5, 1 << 40, (1 << 48) - 1], np.uint64)
    counts = np.array([1, 2**32 - 1, 3, 1, 7], np.int64)
    got = phrases._unpacked(phrases._packed(keys, counts), 5)
    assert (got[0] == keys).all() and (got[1] == counts).all()


def test_bit_table(spark):
    some = np.array([0, 1, -1, 1 << 62, -(1 << 63), 12345678901234567], np.int64)
    table = bit_table(spark.createDataFrame([(int(x),) for x in some], "kv long"), "kv")
    assert in_table(table, some.view(np.uint64)).all() and int(np.bitwise_count(table).sum()) <= len(some)
    assert not in_table(bit_table(spark.createDataFrame([], "kv long"), "kv"), some.view(np.uint64)).any()


def test_exact_products(spark):
    """Products beyond 64 bits, and a floor that doubles would miss."""
    found = spark.createDataFrame([("en", 1, "x", 10**13 + 1), ("en", 1, "y", 10**13 - 1), ("en", 2, "x y", 10**12 + 7)],
                                  "lang string, k int, phrase string, f long")
    totals = spark.createDataFrame([("en", 10**14 + 3)], "lang string, n long")
    (r,) = phrases.scored(found, totals, Mining()).collect()
    assert r.score == 1000 * (10**12 + 7) * (10**14 + 3) // ((10**13 + 1) * (10**13 - 1))


def test_empty_table(spark, docs):
    assert mined(docs.limit(0), Mining()) == []
    assert mined(docs.where("text is null"), Mining(least=1)) == []
