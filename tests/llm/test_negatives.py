import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from sealframe.llm import negatives
from sealframe.llm.negatives import Heaps, Mining, hard_negatives, integers, product, strassen


@pytest.mark.parametrize("n,d,m,leaf", [(1, 1, 1, 1), (7, 5, 9, 1), (33, 64, 100, 4), (0, 3, 4, 2), (3, 0, 4, 1), (40, 40, 40, 64), (65, 33, 129, 16)])
def test_strassen(n, d, m, leaf):
    draw = np.random.default_rng(n * d + m)
    a, b = draw.integers(-1000, 1000, (n, d)), draw.integers(-1000, 1000, (d, m))
    assert (strassen(a, b, leaf) == a @ b).all()
    assert (strassen(a.astype(object), b.astype(object), leaf) == a @ b).all()


def test_sums_in_between_may_overflow():
    """The ring of 64-bit integers: only the result must fit."""
    a = np.array([[2 ** 62, 2 ** 62], [2 ** 62, 1]])
    b = np.array([[1, -1], [-1, 1]])
    assert (strassen(a, b, 1) == np.array([[0, 0], [2 ** 62 - 1, 1 - 2 ** 62]])).all()


@settings(deadline=None, max_examples=50)
@given(st.lists(st.lists(st.integers(-2 ** 40, 2 ** 40), min_size=3, max_size=3), min_size=1, max_size=9))
def test_products_are_exact(rows):
    a = np.array(rows)
    want = [[sum(int(x) * int(y) for x, y in zip(p, q)) for q in rows] for p in rows]
    assert product(a, a).tolist() == want


def test_integers():
    assert integers(np.array([[-0.001, 0.999], [1.0, -1.0]]), 256.0).tolist() == [[-1, 255], [256, -256]]
    assert integers(np.array([[1e30]]), 256.0).tolist() == [[int(1e30 * 256)]]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.tuples(st.integers(-3, 3), st.integers(0, 5)), max_size=8), max_size=5), st.integers(1, 4))
def test_heaps_merge(parts, k):
    """Heaps of parts, in any order, give the heap of all."""
    heap, row, every = Heaps(1, k), 0, []
    for part in parts:
        named = [(s, i, row + n) for n, (s, i) in enumerate(part)]
        row += len(part)
        every += named
        if named:
            heap.push(0, *(np.array(c) for c in zip(*named)))
    assert [tuple(x) for x in heap.kept[0].tolist()] == sorted(every, key=lambda x: (-x[0], x[1], x[2]))[:k]


def test_window():
    assert Mining().window(10) == (3, 9) and Mining().window(0) == (0, 0)
    low, high = Mining().window(-10)
    assert low > high
    assert Mining().window(2 ** 62) == (-(-30 * 2 ** 62 // 100), 90 * 2 ** 62 // 100)


def plain(rows, step=10, rules=Mining()):
    """Every anchor with every row."""
    good = [(i, y, tuple(math.floor(256 * x) for x in v)) for i, v, y in rows
            if None not in (i, y) and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, y, v) in enumerate(good):
        if i % step:
            continue
        scored = sorted((-sum(p * q for p, q in zip(v, w)), j, c, z) for c, (j, z, w) in enumerate(good) if c != a and len(v) == len(w))
        for s, j, _, _ in [x for x in scored if x[3] == y][:rules.positives]:
            fit = [x for x in scored if x[3] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:rules.negatives]
            out += [(i, j, n + 1, x[1], -s, -x[0]) for n, x in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("tile,strip", [(16 << 20, 256), (2048, 7)])
def test_vectors(spark, monkeypatch, tile, strip):
    monkeypatch.setattr(negatives, "TILE", tile)
    monkeypatch.setattr(negatives, "STRIP", strip)
    draw = np.random.default_rng(5)
    rows = [(i, [float(x) for x in draw.normal(0.1, 0.3, 6)], int(draw.integers(0, 3))) for i in range(300)]
    rows += [(1000 + i, rows[0][1], rows[0][2] if i % 2 else 7) for i in range(60)]  # one very common vector, many ties
    rows += [rows[10], rows[10], (20, rows[3][1], 1), (None, rows[1][1], 1), (410, None, 1), (420, rows[5][1], None), (430, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1),
             (440, [math.nan] * 6, 1), (450, [math.inf] * 6, 1), (460, [], 1), (461, [], 1), (462, [], 2), (470, [1.0, 2.0], 1), (471, [1.0, 1.5], 1), (472, [0.5, 1.0], 2),
             (480, [-1.0] * 6, 99), (490, [0.0] * 6, 1)]
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id bigint, embedding array<double>, label int, tile string, row int").repartition(4)
    got = sorted(tuple(r) for r in hard_negatives(frame, lambda i: i % 10 == 0).collect())
    want = plain(rows)
    assert got == want and len(want) > 500


def test_scores_beyond_doubles(spark):
    """Components of 2 ** 40: sums of products that doubles would round."""
    big = 2.0 ** 22
    rows = [(0, [big, big], 1), (1, [big + 2 ** -8, big], 1), (2, [big, big + 2 ** -7], 1), (3, [big / 2, big / 2 + 2 ** -8], 2), (4, [big / 2, big / 2], 2)]
    got = sorted(tuple(r) for r in hard_negatives(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), lambda i: i % 10 == 0).collect())
    assert got == plain(rows) and len(got) == 4


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives(empty, lambda i: i % 10 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1), (3, [1.0], 2)], "vec_id bigint, embedding array<float>, label int")
    assert hard_negatives(alone, lambda i: i % 10 == 0).collect() == []
