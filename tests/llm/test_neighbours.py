import awkward
import numpy as np
import pytest
from tellwatt.llm.neighbours import chi_square_limit, grown, nearest, op5_neighbours, usable

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], np.float32).astype(float)
    for q in sorted(set(ids[ids % 100 == 0].tolist())):
        best = {}
        for v in vectors[ids == q]:
            for i, s in zip(ids.tolist(), np.sqrt(((vectors - v) ** 2).sum(1)).tolist()):
                if i != q:
                    best[i] = min(s, best.get(i, np.inf))
        for rank, (i, s) in enumerate(sorted(best.items(), key=lambda x: (x[1], x[0]))[:k], 1):
            yield q, rank, i, s


def table(spark, folder, rows):
    return awkward.saved(spark, folder, embeddings=spark.createDataFrame([(*r, 1) for r in rows], SCHEMA))


def rounded(rows):
    return sorted((q, rank, i, round(s, 9)) for q, rank, i, s in rows)


def test_recall(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k, rng.standard_normal(24).tolist()) for k in range(4000)]
    got = [tuple(r) for r in op5_neighbours(spark, table(spark, str(tmp_path), rows)).collect()]
    want = list(brute(rows))
    score = {(q, i): s for q, _, i, s in want}
    hits = [r for r in got if (r[0], r[2]) in score]
    assert len(got) == len(want) and len(hits) >= 0.95 * len(want)
    assert all(s == pytest.approx(score[q, i], abs=1e-12) for q, _, i, s in hits)


def test_ties_repeats_and_few_rows(spark, tmp_path):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(0, 500, 25)] + [(7, [1.0, 2.0, 4.0]), (7, [1.0, 2.0, 4.0]), (7, [9.0, 2.0, 4.0])]
    assert rounded(op5_neighbours(spark, table(spark, f"{tmp_path}/a", rows)).collect()) == rounded(brute(rows))
    few = [(0, [1.0, 0.0]), (5, [0.0, 1.0]), (6, [0.5, 1.0])]
    assert rounded(op5_neighbours(spark, table(spark, f"{tmp_path}/b", few)).collect()) == rounded(brute(few))


def test_hot_vector(spark, tmp_path):
    """Equal vectors can't be told apart by a tree; they are dealt out in parts."""
    rng = np.random.default_rng(2)
    rows = [(k, ([1.0] * 8 if k % 3 else rng.standard_normal(8).tolist())) for k in range(9000)]
    got = sorted(tuple(r) for r in op5_neighbours(spark, table(spark, str(tmp_path), rows)).collect())
    want = sorted(brute(rows))
    assert len(got) == len(want) and sum(a[2] == b[2] for a, b in zip(got, want)) >= 0.95 * len(want)


def test_what_takes_part(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, []), (7, [1.0]), (8, [2.0, 2.0]), (100, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert sorted(r.vec_id for r in usable(df).collect()) == [0, 8]
    folder = awkward.saved(spark, str(tmp_path), embeddings=df)
    assert [tuple(r) for r in op5_neighbours(spark, folder).collect()] == [(0, 1, 8, 1.0)]


def test_empty(spark, tmp_path):
    folder = awkward.saved(spark, str(tmp_path), embeddings=spark.createDataFrame([], SCHEMA))
    assert op5_neighbours(spark, folder).collect() == []
    one = usable(spark.createDataFrame([(1, [1.0], 1)], SCHEMA))
    assert nearest(one, one).collect() == []


def test_tree_and_limit():
    points = np.random.default_rng(3).standard_normal((500, 4))
    tree = grown(points, 13)
    leaf = tree.leaves(points)
    assert len(tree.low) == 13 and (np.bincount(leaf, minlength=13) > 10).all()
    assert np.allclose(tree.distances(points)[np.arange(500), leaf], 0)
    assert len(grown(np.ones((50, 4)), 8).low) == 1 and len(grown(np.zeros((0, 4)), 8).low) == 1
    assert chi_square_limit(8, 0.95) == pytest.approx(15.5073, abs=1e-3)
