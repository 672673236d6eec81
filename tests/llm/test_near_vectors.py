"""Links near the threshold against brute force, on narrow vectors and around a common mean."""

import numpy as np
import pytest

from linkloom.llm import hamming


@pytest.mark.parametrize(("width", "shift"), [(16, 0.0), (32, 0.0), (64, 1.0), (64, 3.0)])
def test_near_vectors_finds_links_at_the_threshold(spark, width, shift):
    rng = np.random.default_rng(width)
    a = hamming.unit(rng.normal(size=(300, width)) + shift)
    z = rng.normal(size=a.shape)
    z = hamming.unit(z - (z * a).sum(1, keepdims=True) * a)
    cosine = rng.uniform(0.9501, 0.96, (300, 1))
    x = np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * z])
    near = x @ x.T / np.sqrt((x * x).sum(1)[:, None] * (x * x).sum(1)) >= 0.95
    wanted = near.sum() - len(x)
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = hamming.near_vectors(vectors).collect()
    found = np.array([r.n_links for r in sorted(rows, key=lambda r: r.vec_id)])
    assert wanted >= 600 and (found <= near.sum(1) - 1).all()
    assert found.sum() >= 0.99 * wanted


def test_learned_codes_are_balanced_and_closer_than_drawn_ones():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1000, 24)) * np.linspace(0.2, 3, 24)  # uneven along the axes
    x = hamming.unit(x) - hamming.unit(x).mean(0)
    learned, drawn = hamming.learned_rotation(x, 1), np.linalg.qr(rng.normal(size=(24, 24)))[0]
    assert np.allclose(learned.T @ learned, np.eye(24))
    away = [((np.where(x @ r >= 0, 1, -1) * np.abs(x @ r).mean() - x @ r) ** 2).sum() for r in (learned, drawn)]
    assert away[0] < away[1] and np.abs((x @ learned >= 0).mean(0) - 0.5).max() < 0.1


@pytest.mark.parametrize("vectors", [[[1.0]], [[1.0], [-2.0], [3.0]], [[1.0, 0.0], [0.99, 0.05]], [[0.0, 1.0]] * 3])
def test_few_or_narrow_vectors(spark, vectors):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = {r.vec_id: r.n_links for r in hamming.near_vectors(rows).collect()}
    x = hamming.unit(np.array(vectors))
    assert [found[i] for i in range(len(x))] == ((x @ x.T >= 0.95).sum(1) - 1).tolist()
