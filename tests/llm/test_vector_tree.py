"""The vector tree against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from valora.llm import vector_tree
from valora.llm.vector_tree import Tree, calibrated_visits, nearest

SCHEMA = "vec_id long, embedding array<float>, query_id long, h1 long, leaf int, rank int, ids string"


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, 3, 4, "x")
                                  for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute(rows, k=20):
    rows = {(i, tuple(np.float32(x) for x in v)) for i, v in rows if i is not None and usable(v)}
    width = max((len(v) for _, v in rows), default=0)
    full = [(i, np.array([*map(float, v), *[0.0] * (width - len(v))])) for i, v in rows]
    return {i: sorted(((-float((v * w).sum()), j) for j, w in full if j != i))[:k] for i, v in full if i % 20 == 0}


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def clustered(n, dim=12, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim))
    return [(k, (centres[rng.integers(30)] + 0.3 * rng.normal(size=dim)).astype(np.float32).tolist()) for k in range(n)]


def test_recall_on_many_vectors(spark):
    rows = clustered(3000)
    got, want = answers(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)), brute(rows)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    shared = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert shared >= 0.9 * 20 * len(want)
    score = {i: np.array(v, float) for i, v in rows}
    for q, found in got.items():
        assert found == sorted(found)
        assert all(s == pytest.approx(-float(score[q] @ score[i]), abs=1e-12) for s, i in found)


def test_full_target_is_exact_with_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(vector_tree, "VECTORS", 37)
    monkeypatch.setattr(vector_tree, "QUERIES", 5)
    rows = clustered(600, 6)
    # a vector that a third of all rows have, queries among them; equal scores; repeated rows
    rows += [(1000 + k, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0]) for k in range(300)] + rows[:5]
    got, want = answers(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, target=1.0)), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]


def test_odd_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (20, None), (40, [0.0, 0.0]), (60, [None, 1.0]), (80, [float("nan"), 1.0]),
            (1, [float("inf"), 1.0]), (2, []), (3, [2.0]), (4, [1.0, 5.0]), (None, [9.0, 9.0]), (100, [0.5, 0.5]),
            (5, [-1.0, 0.0])]
    assert answers(nearest(frame(spark, rows), F.col("vec_id") % 20 == 0)) == brute(rows)
    assert nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(frame(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(frame(spark, [(1, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0


def test_tree_and_calibration():
    rows = np.random.default_rng(1).normal(size=(500, 4))
    tree = Tree(rows, leaf=20, branch=4)
    at = tree.place(rows)
    assert max(np.bincount(at)) <= 20 or tree.leaves > 25
    assert all(not tree.children[x] for x in set(at))
    assert sorted(tree.visits(rows[0], tree.leaves)) == [k for k, c in enumerate(tree.children) if not c]
    order = tree.visits(rows[0], tree.leaves)
    assert calibrated_visits(tree, rows[:1], [(0, order[0]), (0, order[4])], 1.0) == 5
    assert calibrated_visits(tree, rows[:1], [(0, order[0]), (0, order[4])], 0.5) == 1
    same = Tree(np.ones((300, 3)), leaf=10)
    assert same.place(np.ones((2, 3))).tolist() == [same.visits(np.ones(3), 1)[0]] * 2 or same.leaves == 1
