import numpy as np
import pytest

from shopsight.llm import ann
from shopsight.llm.hilbert import positions


@pytest.mark.parametrize(("axes", "bits"), [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_neighbours(axes, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
    place = positions(grid, bits)
    assert sorted(place.tolist()) == list(range(len(grid)))
    walk = grid[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def brute(vectors, every, k):
    ids = sorted(vectors)
    m = np.array([vectors[i] for i in ids])
    out = {}
    for i in ids:
        if i % every == 0:
            s = (m * np.array(vectors[i])).sum(axis=1)
            order = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != i)[:k]
            out[i] = [(d, -x) for x, d in order]
    return out


def frame(spark, vectors, extra=()):
    rows = [(i, [float(x) for x in v], 1, "s") for i, v in vectors.items()] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int, score string").repartition(4)


def test_recall_and_scores(spark):
    r = np.random.default_rng(1)
    vectors = {i: v for i, v in enumerate((r.normal(size=(1500, 24)) * r.uniform(0.5, 2, (1500, 1))).astype(np.float32))}
    vectors |= {5000 + i: vectors[7] for i in range(200)}  # one common vector
    bad = [(9000, None, 1, "x"), (9020, [0.0] * 24, 1, "x"), (9040, [float("nan")] * 24, 1, "x"),
           (9060, [1.0] * 3, 1, "x"), (9080, [None] * 24, 1, "x"), (None, [1.0] * 24, 1, "x"), (9100, [], 1, "x")]
    rows = ann.search(frame(spark, vectors, bad), rule=ann.Curves(members=100, queries=20)).collect()
    want = brute({i: np.float64(v) for i, v in vectors.items()}, 20, 20)
    assert {x.query_id for x in rows} == set(want)
    hits = 0
    for q, best in want.items():
        got = sorted((x for x in rows if x.query_id == q), key=lambda x: x.rank)
        assert [x.rank for x in got] == list(range(1, len(got) + 1))
        assert [(-x.score, x.vec_id) for x in got] == sorted((-x.score, x.vec_id) for x in got)
        for x in got:
            exact = float((np.float64(vectors[q]) * np.float64(vectors[x.vec_id])).sum())
            assert x.vec_id != q and abs(x.score - exact) < 1e-9
        hits += len({x.vec_id for x in got} & {d for d, _ in best})
    assert hits >= 0.9 * 20 * len(want)


def test_few_and_no_vectors(spark):
    few = frame(spark, {0: [1.0, 0.0], 1: [0.5, 0.5], 2: [0.5, 0.5]})
    got = [tuple(r) for r in ann.search(few).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 2, 0.5)]
    assert ann.search(few.limit(0)).count() == 0


def test_a_vector_of_a_third_of_the_rows_shows_its_smallest_ids(spark):
    r = np.random.default_rng(2)
    vectors = {i: v for i, v in enumerate(r.normal(size=(5400, 16)).astype(np.float32))}
    common = 3 * vectors[7]
    vectors |= {int(i): common for i in r.permutation(5400)[:1800]}
    got = ann.search(frame(spark, vectors)).collect()
    want = {q: best for q, best in brute({i: np.float64(v) for i, v in vectors.items()}, 20, 20).items()
            if len({tuple(vectors[d]) for d, _ in best}) == 1}
    assert len(want) > 100
    found = {q: [] for q in want}
    for x in sorted(got, key=lambda x: x.rank):
        if x.query_id in found:
            found[x.query_id].append(x.vec_id)
    hits = sum(len(set(found[q]) & {d for d, _ in best}) for q, best in want.items())
    assert hits >= 0.9 * 20 * len(want)
    assert all(found[q] == [d for d, _ in want[q]] for q in want if tuple(vectors[q]) == tuple(common))
