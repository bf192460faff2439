import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopsight.llm import ranker
from shopsight.llm.ranker import Ranking
from tests.conftest import SF01


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    got = ranker.classify(docs, labels).cache()
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    assert [f.dataType.typeName() for f in got.schema] == ["long", "boolean", "double", "integer"]
    rows = got.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    told = got.where("held_out").join(labels, "doc_id").toPandas()
    good, bad = told[told.quality == 1].score.to_numpy(), told[told.quality == 0].score.to_numpy()
    assert len(bad) >= 10 and (good[:, None] > bad[None]).mean() > 0.98
    assert (told.predicted == told.quality).mean() > 0.97
    # the labels of held-out rows teach nothing
    flipped = labels.withColumn("quality", F.when(ranker.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(ranker.classify(docs, flipped).collect()) == sorted(rows)


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, int(i < 120)) for i in range(0, 140)] + [(3, 0), (None, 1), (None, 0), (5, None), (7, 3)]
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_odd_rows(spark, docs, labelled):
    got = ranker.classify(docs, labelled).collect()
    assert len(got) == docs.count()
    assert all(r.score is not None and 0 <= r.score <= 1 for r in got)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, set()).add((r.score, r.held_out, r.predicted))
    assert len(by_id[133]) == 1 and len(by_id[None]) == 2  # equal rows alike; of the null ids one has a text
    assert {r.held_out for r in got if r.doc_id is None} == {zlib.crc32(b"") % 4 == 2}


@pytest.mark.parametrize("which", ["quality = 1", "quality = 9", "quality = 0"])
def test_without_both_labels(spark, docs, labelled, which):
    got = ranker.classify(docs, labelled.where(which)).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.5, 0)}
    assert ranker.classify(docs.limit(0), labelled).count() == 0


def test_features_of_single_texts_and_batches():
    texts = ["", "a", "A!! B!! A!! B!! A!! B!!", "one two\none two\n\nthree", "Ä ö\x0bü", "w " * 60, "\n\n", "x"]
    raw = [t.encode() for t in texts]
    whole = ranker.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for k, b in enumerate(raw):
        one = ranker.features(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
        assert np.allclose(one[0], whole[k]), texts[k]
    assert not whole[0][3:].any() and np.isfinite(whole).all()


def test_preferences_and_threshold():
    draw = np.random.default_rng(1)
    good, bad = draw.normal(0, 1, (400, 3)) + [2, 0, 0], draw.normal(0, 1, (300, 3))
    m = ranker.bradley_terry(good, bad, 0.3, Ranking(pairs=20_000))
    assert m.weights[0] > 5 * abs(m.weights[1:]).max()
    # 0.3 of the population lies below the threshold, whatever the sample's shares
    below = 0.7 * (good @ m.weights < m.threshold).mean() + 0.3 * (bad @ m.weights < m.threshold).mean()
    assert abs(below - 0.3) < 0.01
    # the learnt differences are log-odds: two thirds of the pairs that they call 2 : 1 are so
    p = 1 / (1 + np.exp(-(good[:, None] - bad[None]) @ m.weights))
    assert abs(p.mean() - ((good[:, None] - bad[None]) @ m.weights > 0).mean()) < 0.05


def _plain_threshold(rows, stands, share):
    """Row by row, good ones first where scores tie."""
    rows = sorted((s, -q) for q, n, s in rows for _ in range(n))
    mass = np.cumsum([stands[-q] for _, q in rows])
    at = int(np.searchsorted(mass, share - 1e-12))
    return (rows[at][0] + rows[min(at + 1, len(rows) - 1)][0]) / 2


def test_every_labelled_row_teaches(spark):
    """In blocks of 20 rows of the commoner label: each learning row is in one
    block of its label, and in as many of the other one as theirs are."""
    draw = np.random.default_rng(7)
    rows = [(i, i, int(i % 3 > 0), [float(v) for v in draw.normal(i % 3 > 0, 1, 3)], 1 + i % 2) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, h long, quality int, x array<double>, n long")
    rule = Ranking(pairs=400)
    seen = {}
    for b in ranker._blocks(df, {1: 400, 0: 200}, rule).collect():
        r = np.frombuffer(b.rows).reshape(-1, 5)
        assert {0.0, 1.0} == set(r[:, 0]) and len(r) < 100
        for x in r:
            seen[tuple(x)] = seen.get(tuple(x), 0) + 1
    assert set(seen) == {(float(q), float(n), *x) for _, _, q, x, n in rows}
    assert all(v == (1 if k[0] else 2) for k, v in seen.items())
    # one block: all pairs, as with the rows at hand
    whole = ranker._blocks(df, {1: 400, 0: 200}, Ranking())
    good, bad = (np.repeat([r[3] for r in rows if r[2] == q], [r[4] for r in rows if r[2] == q], axis=0) for q in (1, 0))
    spread = np.concatenate([good, bad]).std(axis=0)
    w = ranker.newton(lambda w: ranker._sums(whole, w, spread), 3, Ranking()) / spread
    assert np.allclose(w, ranker.bradley_terry(good, bad, 0.3, Ranking()).weights, atol=1e-9)


def test_threshold_over_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ranker, "_FEW", 3)
    monkeypatch.setattr(ranker, "_PARTS", 4)
    draw = np.random.default_rng(8)
    for share, places in ((0.3, 1), (0.5, 6), (0.07, 0)):
        rows = [(int(i % 3 > 0), 1 + i % 2, round(float(draw.normal(i % 3 > 0)), places)) for i in range(90)]
        total = {q: sum(n for p, n, _ in rows if p == q) for q in (0, 1)}
        stands = {0: share / total[0], 1: (1 - share) / total[1]}
        got = ranker._threshold(spark.createDataFrame(rows, "quality int, n long, s double").coalesce(1), stands, share)
        assert got == _plain_threshold(rows, stands, share)
