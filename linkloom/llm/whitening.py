"""Whitening of embeddings by exact covariances, found by polarisation.

With z = n * x - S, the centred values times n, every entry of the covariance follows from
variances alone: 2 * cov(a, b) = var(a + b) - var(a) - var(b). So tasks sum the squares of z for
every dimension and of z_a + z_b for every pair of dimensions, as whole numbers; what is shuffled
is one row per task and pair. The driver holds dimensions squared many sums, solves the
eigenproblem, and sends a few axes back.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.common import carried, table
from linkloom.session import materialise

#: Steps of a component per unit, and how many components are kept.
SCALE, COMPONENTS = 256, 4
#: Whole numbers of any size travel as this many digits of base 2**32, the last one signed.
LIMBS = 10
#: Rows whose squares are summed in 64 bits before they join the long sum.
FEW = 4096

_SUM_NAMES = ["width", "a", "b", *(f"l{k}" for k in range(LIMBS))]
_SUM_SCHEMA = "width int, a int, b int, " + ", ".join(f"l{k} long" for k in range(LIMBS))


@dataclass(frozen=True)
class Whitening:
    """What the vectors of one width are whitened with."""

    n: int
    sums: list[int]
    axes: np.ndarray  # one row per component, already divided by the root of its eigenvalue
    explained: list[float]


def whole_vectors(vectors: DataFrame, column: str = "embedding", scale: int = SCALE) -> DataFrame:
    """Rows whose vector is complete and finite, with ``x``, its components in whole steps.

    A null vector, or one with a null, NaN or infinite entry, is left out. Steps beyond 64 bits
    stay at the largest or smallest long.
    """
    finite = F.forall(column, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(column, lambda c: F.floor(c.cast("double") * float(scale)))
    return vectors.filter(F.col(column).isNotNull() & finite).withColumn("x", whole.cast("array<bigint>"))


def _matrices(batch: pa.RecordBatch, column: str):
    """``(width, rows, matrix)`` of the vectors of each width in an Arrow batch."""
    lists = batch.column(column)
    widths = np.diff(lists.offsets.to_numpy())
    flat, starts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()[:-1]
    for width in np.unique(widths).tolist():
        rows = np.flatnonzero(widths == width)
        yield width, rows, flat[starts[rows, None] + np.arange(width)]


def _limbs(value: int) -> list[int]:
    low = [(value >> (32 * k)) & 0xFFFFFFFF for k in range(LIMBS - 1)]
    return [*low, value >> (32 * (LIMBS - 1))]


def _exact_sums(rows: DataFrame, fold) -> dict[tuple[int, int, int], int]:
    """Sums ``{(width, a, b): value}`` of whole numbers of any size.

    ``fold(width, matrix)`` gives ``{(a, b): value}`` of the vectors of an Arrow batch.
    """

    def run(batches):
        sums: dict[tuple[int, int, int], int] = {}
        for batch in batches:
            for width, _, x in _matrices(batch, "x"):
                for (a, b), value in fold(width, x).items():
                    sums[width, a, b] = sums.get((width, a, b), 0) + value
        if sums:
            columns = zip(*((*key, *_limbs(v)) for key, v in sums.items()))
            kinds = [*[pa.int32()] * 3, *[pa.int64()] * LIMBS]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], _SUM_NAMES)

    parts = rows.select("x").mapInArrow(run, _SUM_SCHEMA)
    total = parts.groupBy("width", "a", "b").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)])
    return {tuple(r[:3]): sum(r[3 + k] << (32 * k) for k in range(LIMBS)) for r in total.collect()}


def _fold_sums(width: int, x: np.ndarray) -> dict:
    """Sums per dimension; the number of vectors stands at dimension -1."""
    few = np.abs(x.astype(np.float64)).max(initial=0) < 2**62 / max(len(x), 1)
    totals = x.sum(0).tolist() if few else x.astype(object).sum(0).tolist()
    return {(-1, -1): len(x)} | {(a, a): int(v) for a, v in enumerate(totals)}


def scaled_and_centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: in 64 bits if the values fit, else as Python numbers."""
    most = float(np.abs(x.astype(np.float64)).max(initial=0)) * n + max(map(abs, sums), default=0)
    if most < 2**61:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _sum_of_squares(y: np.ndarray) -> list[int]:
    """Exact sums of squares of each column."""
    if y.dtype == object:
        return [int(v) for v in (y * y).sum(0)]
    low = int(np.abs(y).max(initial=0)).bit_length() // 2 + 1  # two halves, so that squares fit
    if 2 * low + FEW.bit_length() > 62:
        return _sum_of_squares(y.astype(object))
    total = [0] * y.shape[1]
    for part in np.array_split(y, range(FEW, len(y), FEW)):
        high, rest = part >> low, part & ((1 << low) - 1)
        squares = (high * high).sum(0).tolist(), (high * rest).sum(0).tolist(), (rest * rest).sum(0).tolist()
        total = [t + (h << (2 * low)) + (c << (low + 1)) + r for t, h, c, r in zip(total, *squares)]
    return total


def _fold_squares(z: np.ndarray) -> dict:
    """Sums of squares of every dimension (a, a) and of every sum of two, (a, b)."""
    out = {(a, a): v for a, v in enumerate(_sum_of_squares(z))}
    for a in range(z.shape[1] - 1):
        pairs = _sum_of_squares(z[:, a : a + 1] + z[:, a + 1 :])
        out |= {(a, a + 1 + k): v for k, v in enumerate(pairs)}
    return out


def polarised_covariance(squares: dict[tuple[int, int], int], width: int, n: int) -> np.ndarray:
    """The covariance with divisor n from sums of squares of z = n * x - S, each entry rounded once."""
    out = np.empty((width, width))
    for a in range(width):
        for b in range(a, width):
            twice = squares[a, b] - squares[a, a] - squares[b, b] if a != b else 2 * squares[a, a]
            out[a, b] = out[b, a] = float(Fraction(twice, 2 * n**3))
    return out


def _axes(covariance: np.ndarray, components: int) -> tuple[np.ndarray, list[float]]:
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    real = values > max(values.max(initial=0.0), 0.0) * len(values) * np.finfo(float).eps
    keep = [i for i in range(min(components, len(values))) if real[i]]
    return (vectors[:, keep] / np.sqrt(values[keep])).T, [float(values[i] / trace) for i in keep]


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each width of the vectors ``x`` in ``fit``, all of whose rows count."""
    moments = _exact_sums(fit, _fold_sums)
    counts = {width: n for (width, a, _), n in moments.items() if a < 0}
    sums = {width: [moments[width, a, a] for a in range(width)] for width in counts}
    squares = _exact_sums(fit, lambda width, x: _fold_squares(scaled_and_centred(x, counts[width], sums[width])))
    out = {}
    for width, n in counts.items():
        mine = {(a, b): v for (w, a, b), v in squares.items() if w == width}
        axes, explained = _axes(polarised_covariance(mine, width, n), components) if width else (np.zeros((0, 0)), [])
        out[width] = Whitening(n, sums[width], axes, explained)
    return out


def _whiten(z: np.ndarray, w: Whitening) -> np.ndarray:
    centred = z / w.n if z.dtype != object else np.array([[float(Fraction(int(v), w.n)) for v in r] for r in z])
    return centred.reshape(len(z), -1) @ w.axes.T


def identity_errors(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """For each width the largest entry of the covariance of the whitened fit list, less the identity."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in _matrices(batch, "x"):
                w = models[width]
                y = _whiten(scaled_and_centred(x, w.n, w.sums), w)
                y = np.hstack([np.ones((len(y), 1)), y])
                sums[width] = sums.get(width, 0.0) + y.T @ y
        for width, total in sums.items():
            a, b = (i.ravel().astype(np.int32) for i in np.indices(total.shape))
            width = np.full(total.size, width, np.int32)
            yield pa.record_batch([pa.array(c) for c in (width, a, b, total.ravel())], ["width", "a", "b", "v"])

    parts = fit.select("x").mapInArrow(run, "width int, a int, b int, v double")
    found = {(r.width, r.a, r.b): r.v for r in parts.groupBy("width", "a", "b").agg(F.sum("v").alias("v")).collect()}
    out = {}
    for width, w in models.items():
        k = len(w.axes) + 1
        total = np.array([[found[width, a, b] for b in range(k)] for a in range(k)]) / w.n
        error = np.abs(total[1:, 1:] - np.outer(total[0, 1:], total[0, 1:]) - np.eye(k - 1))
        out[width] = float(error.max(initial=0.0))
    return out


def whiten_vectors(
    vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS, carry: bool = False
) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per row and component.

    The axes are those of the distinct vectors, each counted once, however often rows repeat them;
    every complete row is whitened, with null and repeated ids too. Rows with an incomplete vector
    are left out. Vectors of different widths are different spaces with a fit each. Axes along
    which the vectors do not vary have no component: a single vector, equal vectors, empty vectors
    and an empty table give no rows. Equal eigenvalues leave their axes open, the same for all
    rows. ``deviation`` is null where it exceeds a long. ``carry`` adds the whole row as ``row``.
    """
    kept, own, extra = carried(vectors, carry)
    named = vectors.select(F.col("vec_id").cast("long"), F.col(column).alias("_v"), *own)
    rows = whole_vectors(named, "_v").drop("_v")
    fit = materialise(rows.select("x").distinct(), "distinct_vectors")
    models = fit_whitening(fit, components)
    errors = identity_errors(fit, models)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [x.split()[0] for x in schema.split(", ")] + kept

    def run(batches):
        for batch in batches:
            for width, at, x in _matrices(batch, "x"):
                w = models[width]
                z = scaled_and_centred(x, w.n, w.sums)
                y, k = _whiten(z, w), len(w.axes)
                if not k or not len(at):
                    continue
                deviation = [d if d < 1 << 63 else None for d in _sum_of_squares(z.T)]
                each = pa.array(np.repeat(at, k))
                columns = [
                    batch.column("vec_id").take(each),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, w.n)),
                    pa.array([d for d in deviation for _ in range(k)], pa.int64()),
                    pa.array(y.ravel()),
                    pa.array(np.tile(w.explained, len(at))),
                    pa.array(np.full(len(at) * k, errors[width])),
                    *(batch.column(c).take(each) for c in kept),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return rows.mapInArrow(run, schema + extra)


def op13_embedding_whitening(spark, sf: str) -> DataFrame:
    return whiten_vectors(table(spark, sf, "embeddings"))
