import math

import numpy as np
import pytest

from sealframe.llm import topk
from sealframe.llm.topk import BallTree, search, top_k


def plain(rows, wanted, k):
    points = set()
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            points.add((i, tuple(math.floor(256 * x) for x in v)))
    out = []
    for i, v in points:
        if wanted(i):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in points if j != i and len(v) == len(w))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("n,size,spread", [(1, 3, 1), (700, 8, 3), (900, 2, 1), (400, 5, 0)])
def test_search(n, size, spread):
    """Many ties: few different values, or identical points."""
    draw = np.random.default_rng(n)
    points, queries = draw.integers(-spread, spread + 1, (n, size)).astype(float), draw.integers(-3, 4, (40, size)).astype(float)
    ids, own = draw.permutation(n).astype(np.int64), np.arange(40)
    q, found, score = search(points, ids, queries, own, np.full(40, -np.inf), 5)
    for i in range(40):
        every = sorted((-int(s), int(j)) for s, j in zip(points @ queries[i], ids) if j != own[i])[:5]
        assert sorted((-int(s), int(j)) for a, j, s in zip(q, found, score) if a == i) == every


def test_floor_prunes_but_keeps_ties():
    points, ids = np.array([[1.0], [2.0], [2.0], [3.0]]), np.array([9, 4, 5, 7])
    q, found, score = search(points, ids, np.array([[1.0]]), np.array([0]), np.array([2.0]), 2)
    assert sorted(zip(score, found)) == [(2, 4), (3, 7)]


def test_bounds_hold():
    points = np.random.default_rng(3).normal(0, 100, (2000, 6)).round()
    tree, queries = BallTree(points), np.random.default_rng(4).normal(0, 90, (20, 6)).round()
    upper, leaves = tree.bounds(queries)
    for column, leaf in enumerate(leaves):
        a, b = tree.ranges[leaf]
        assert ((queries @ points[tree.order[a:b]].T).max(axis=1) <= upper[:, column]).all()


def test_large_integers_are_exact():
    points = np.array([[2.0 ** 28 + 1, 2.0 ** 28], [2.0 ** 28, 2.0 ** 28 + 1], [3.0, 1.0]])
    _, found, score = search(points, np.array([1, 2, 3]), np.array([[2.0 ** 28 + 3, 2.0 ** 28]]), np.array([0]), np.array([-np.inf]), 1)
    assert found.tolist() == [1] and score[0] == (2 ** 28 + 1) * (2 ** 28 + 3) + 2 ** 56


@pytest.mark.parametrize("shard,block", [(16_384, 4_096), (64, 5)])
def test_vectors(spark, monkeypatch, shard, block):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    draw = np.random.default_rng(8)
    rows = [(i, [float(x) for x in draw.normal(0, 0.2, 6)]) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [rows[10], rows[10], (20, rows[3][1]), (None, rows[1][1]), (600, None), (650, [1.0, None, 1.0, 1.0, 1.0, 1.0]),
             (700, [math.nan] * 6), (750, [math.inf] * 6), (800, []), (850, [1.0, 2.0]), (900, [2.0, 1.0]), (950, [1e30 ** 0, 0.0, -0.0])]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id bigint, embedding array<double>, score string").repartition(4)
    got = sorted(tuple(r) for r in top_k(frame, lambda i: i % 50 == 0).collect())
    assert got == plain(rows, lambda i: i % 50 == 0, 5)


def test_no_vectors(spark):
    assert top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>"), lambda i: i % 50 == 0).collect() == []


def test_clustered_vectors_are_pruned():
    """Fifty tight clusters: less than half of the leaves are read, and the result is that of trying all."""
    draw = np.random.default_rng(12)
    centers = draw.normal(0, 100, (50, 32))
    points = np.concatenate([c + draw.normal(0, 2, (200, 32)) for c in centers]).round()
    points = points[draw.permutation(len(points))]
    ids, queries, counted = np.arange(len(points)), points[::50], {}
    q, found, score = search(points, ids, queries, ids[::50], np.full(len(queries), -np.inf), 5, counted)
    assert counted["read"] < 0.5 * counted["leaves"], counted
    every = queries @ points.T
    for i in range(len(queries)):
        want = sorted((-int(s), int(j)) for j, s in enumerate(every[i]) if j != 50 * i)[:5]
        assert sorted((-int(s), int(j)) for a, j, s in zip(q, found, score) if a == i) == want


def test_a_floor_rules_subtrees_out():
    draw = np.random.default_rng(13)
    points = np.concatenate([draw.normal(0, 1, (2000, 8)), draw.normal(0, 1, (2000, 8)) + 50]).round()
    tree, queries = BallTree(points), np.full((1, 8), 3.0)
    every = tree.reached(queries, np.array([-np.inf]))
    some = tree.reached(queries, np.array([1000.0]))
    assert len(some[0]) <= 0.6 * len(every[0]) and len(every[0]) == (tree.children[:, 0] < 0).sum()
