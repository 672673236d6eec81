"""Model weights: small arrays held by the driver and written as a table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from linkloom.functions.draws import driver_draw


@dataclass(frozen=True)
class SageLayer:
    """One convolution. ``kind`` is ``mean``, ``pool`` (max) or ``mean_pool``."""

    self_: np.ndarray
    neigh: np.ndarray
    bias: np.ndarray
    kind: str = "mean"
    pool: np.ndarray | None = None
    pool_bias: np.ndarray | None = None

    @property
    def in_width(self) -> int:
        return self.self_.shape[1]

    @property
    def out_width(self) -> int:
        return self.self_.shape[0]


@dataclass(frozen=True)
class SageModel:
    """Two convolutions and a linear link classifier on ``[h_src; h_dst]``."""

    weights: dict[str, np.ndarray]
    kind: str = "mean"

    def layer(self, nth: int) -> SageLayer:
        w = self.weights
        return SageLayer(
            w[f"{nth}.self"],
            w[f"{nth}.neigh"],
            w[f"{nth}.bias"],
            self.kind,
            w.get(f"{nth}.pool"),
            w.get(f"{nth}.pool_bias"),
        )

    @property
    def first(self) -> SageLayer:
        return self.layer(1)

    @property
    def second(self) -> SageLayer:
        return self.layer(2)

    @property
    def head(self) -> tuple[np.ndarray, np.ndarray, float]:
        """Classifier weights of the source, of the destination, and the intercept."""
        w, b = self.weights["3.head"], self.weights["3.bias"]
        half = w.shape[1] // 2
        return w[0, :half], w[0, half:], float(b[0])


def weight_shapes(widths: tuple[int, int, int], kind: str) -> dict[str, tuple[int, ...]]:
    """Shapes by ``layer.part`` name for input, hidden and output widths."""
    shapes: dict[str, tuple[int, ...]] = {}
    for nth, (n_in, n_out) in enumerate(zip(widths, widths[1:]), start=1):
        shapes[f"{nth}.self"] = (n_out, n_in)
        shapes[f"{nth}.neigh"] = (n_out, n_in)
        shapes[f"{nth}.bias"] = (n_out,)
        if kind != "mean":
            shapes[f"{nth}.pool"] = (n_in, n_in)
            shapes[f"{nth}.pool_bias"] = (n_in,)
    shapes["3.head"] = (1, 2 * widths[-1])
    shapes["3.bias"] = (1,)
    return shapes


def drawn_model(
    widths: tuple[int, int, int], kind: str = "mean", seed: int = 3, scaled: bool = False
) -> SageModel:
    """Weights ``draw - 0.5`` by (layer, part, out, in); ``scaled`` divides by sqrt(inputs)."""
    weights = {}
    for name, shape in weight_shapes(widths, kind).items():
        layer, part = name.split(".")
        values = np.empty(shape)
        for at in np.ndindex(shape):
            out, into = at if len(at) == 2 else (at[0], 0)
            values[at] = driver_draw(seed, layer, part, out, into) - 0.5
        if scaled:
            values = 2.0 * values / np.sqrt(shape[-1] if len(shape) == 2 else widths[0])
        weights[name] = values
    return SageModel(weights, kind)


def save_model(spark: SparkSession, model: SageModel, path: str) -> None:
    """Write the weights as rows ``(layer, part, out, in, w)``; weights at the same path are replaced."""
    rows = [
        (int(name.split(".")[0]), name.split(".")[1], at[0], at[1] if len(at) == 2 else -1, float(v))
        for name, values in model.weights.items()
        for at, v in np.ndenumerate(values)
    ]
    table = spark.createDataFrame(rows, "layer int, part string, out int, `in` int, w double")
    table.coalesce(1).write.mode("overwrite").parquet(f"{path}/kind={model.kind}")


def load_model(weights: DataFrame) -> SageModel:
    """Read a model back from the table ``save_model`` wrote."""
    rows = weights.collect()
    kind = rows[0]["kind"]
    found: dict[str, dict[tuple[int, ...], float]] = {}
    for r in rows:
        at = (r["out"],) if r["in"] < 0 else (r["out"], r["in"])
        found.setdefault(f"{r['layer']}.{r['part']}", {})[at] = r["w"]
    arrays = {}
    for name, cells in found.items():
        values = np.empty(tuple(max(axis) + 1 for axis in zip(*cells)))
        for at, v in cells.items():
            values[at] = v
        arrays[name] = values
    return SageModel(arrays, kind)
