"""Vector expressions on ``array<double>`` columns.

Narrow maps are spelled out element by element and stay in generated code; wide
ones are one matrix product per Arrow batch. Array lambdas, which are interpreted,
measured slower than both at every width and are left to vectors of unknown length.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many multiplications per row are spelled out.
SPELLED_OUT = 64


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def relu(v: Column) -> Column:
    return F.transform(v, lambda x: F.greatest(F.lit(0.0), x))


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def concat(u: Column, v: Column) -> Column:
    return F.concat(u, v)


def dot(u: Column, v: Column, width: int) -> Column:
    """Inner product of two vectors of ``width`` elements."""
    if width > SPELLED_OUT:
        return _arrow_dot()(u, v)
    return reduce(Column.__add__, [u[i] * v[i] for i in range(width)])


def affine(
    terms: list[tuple[Column, np.ndarray | None]], bias: np.ndarray | None, activate: bool = False
) -> Column:
    """``sum(W @ v) + bias`` over ``(v, W)`` terms, W None standing for identity.

    ``activate`` applies the elementwise ``max(0, .)``.
    """
    n_out = next(len(w) for w in (*[w for _, w in terms], bias) if w is not None)
    if sum(w.size for _, w in terms if w is not None) > SPELLED_OUT:
        return _arrow_affine([w for _, w in terms], bias, activate)(*[v for v, _ in terms])
    elements = []
    for o in range(n_out):
        parts = [F.lit(float(bias[o]))] if bias is not None else []
        for v, w in terms:
            if w is None:
                parts.append(v[o])
            else:
                parts += [v[i] * float(w[o, i]) for i in range(w.shape[1])]
        total = reduce(Column.__add__, parts)
        elements.append(F.greatest(F.lit(0.0), total) if activate else total)
    return F.array(*elements)


def linear(
    v: Column, weight: np.ndarray, bias: np.ndarray | None = None, activate: bool = False
) -> Column:
    """``weight @ v + bias`` for a driver-held weight of shape (out, in)."""
    return affine([(v, weight)], bias, activate)


def _rows(v: pa.Array) -> np.ndarray:
    return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)


def _lists(m: np.ndarray) -> pa.Array:
    offsets = np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(m.ravel()))


def _arrow_affine(weights: list[np.ndarray | None], bias: np.ndarray | None, activate: bool):
    def combine(*vectors: pa.Array) -> pa.Array:
        if not len(vectors[0]):
            return pa.array([], pa.list_(pa.float64()))
        m = sum(_rows(v) if w is None else _rows(v) @ w.T for v, w in zip(vectors, weights))
        m = m if bias is None else m + bias
        return _lists(np.maximum(m, 0.0) if activate else m)

    @F.arrow_udf("array<double>")
    def one(v: pa.Array) -> pa.Array:
        return combine(v)

    @F.arrow_udf("array<double>")
    def two(u: pa.Array, v: pa.Array) -> pa.Array:
        return combine(u, v)

    return one if len(weights) == 1 else two


def _arrow_dot():
    @F.arrow_udf("double")
    def product(u: pa.Array, v: pa.Array) -> pa.Array:
        if not len(u):
            return pa.array([], pa.float64())
        return pa.array((_rows(u) * _rows(v)).sum(1))

    return product
