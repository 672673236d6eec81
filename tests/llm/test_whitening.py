"""Whitening against numpy, exact sums of any size, odd vectors."""

import random
from fractions import Fraction

import numpy as np
import pytest

from linkloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, x string, component int"


def rows_of(spark, vectors, schema=SCHEMA):
    data = [(i, v, "clash", 9) if schema == SCHEMA else (i, v) for i, v in vectors]
    return whitening.whiten_vectors(spark.createDataFrame(data, schema).repartition(3)).collect()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(1)
    a = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6)) + 3).astype(np.float32)
    vectors = [(i, [float(c) for c in v]) for i, v in enumerate(a)]
    vectors += [(1000, vectors[0][1]), (0, vectors[0][1]), (None, vectors[1][1])] * 5  # repeats count once
    vectors += [(2000, None), (2001, [1.0] * 5 + [float("nan")]), (2002, [float("inf")] * 6), (2003, [None] * 6)]
    found = rows_of(spark, vectors)
    x = np.unique(np.floor(256 * a.astype(float)), axis=0)
    n, d = x.shape
    values, axes = np.linalg.eigh(np.cov(x.T, bias=True))
    assert len(found) == 4 * (300 + 15) and {r.n for r in found} == {n}
    assert max(r.identity_error for r in found) < 1e-9
    whole = np.floor(256 * a.astype(float)).astype(np.int64)
    centre = whole * n - x.sum(0).astype(np.int64)
    for k in range(1, 5):
        e, v = values[-k], axes[:, -k]
        mine = np.array([r.whitened for r in sorted((r for r in found if r.component == k and r.vec_id is not None and r.vec_id < 300), key=lambda r: r.vec_id)])
        true = (centre / n) @ v / np.sqrt(e)
        ids = sorted(r.vec_id for r in found if r.component == k and r.vec_id is not None and r.vec_id < 300)
        assert np.allclose(mine * np.sign(mine @ true[ids]), true[ids], atol=1e-8)
        assert [r.explained for r in found if r.component == k] == pytest.approx([e / values.sum()] * 315)
    by_id = {r.vec_id: r.deviation for r in found}
    assert all(by_id[i] == int((centre[i] ** 2).sum()) for i in range(300))


def test_sums_are_exact_at_any_size():
    rng = random.Random(3)
    for most in (10, 1 << 20, 1 << 40, 1 << 60):
        x = np.array([[rng.randint(-most, most) for _ in range(4)] for _ in range(50)], np.int64)
        n, sums = 50, [sum(int(v) for v in x[:, k]) for k in range(4)]
        assert whitening._fold_sums(4, x) == {(-1, -1): 50} | {(k, k): sums[k] for k in range(4)}
        z = whitening.scaled_and_centred(x, n, sums)
        exact = [[n * int(v) - s for v, s in zip(row, sums)] for row in x]
        squares = whitening._fold_squares(z)
        for a in range(4):
            for b in range(a, 4):
                assert squares[a, b] == sum((r[a] + r[b]) ** 2 if a != b else r[a] ** 2 for r in exact)
        v = whitening.polarised_covariance(squares, 4, n)
        assert v[1, 3] == float(Fraction(sum(r[1] * r[3] for r in exact), n**3))
        for value in (0, 5, -5, most**4, -(most**4)):
            assert sum(d << (32 * k) for k, d in enumerate(whitening._limbs(value))) == value


@pytest.mark.parametrize("vectors", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 4, [(1, [])], [(1, None)]])
def test_nothing_to_whiten(spark, vectors):
    assert rows_of(spark, vectors) == []


def test_flat_and_uneven_vectors(spark):
    """Axes that don't vary have no component; widths are spaces of their own; huge entries stay exact."""
    found = rows_of(spark, [(1, [1.0, 0.0, 5.0]), (2, [2.0, 0.0, 5.0]), (3, [3.0, 0.0, 5.0]), (4, [1.0]), (5, [3.0])])
    assert {(r.vec_id, r.component, r.n) for r in found} == {(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 1, 2), (5, 1, 2)}
    assert sorted(round(r.whitened, 6) for r in found if r.n == 2) == [-1.0, 1.0]
    huge = rows_of(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.deviation for r in huge} == {1: None, 2: None, 3: 1 + 768**2}
