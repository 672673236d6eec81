"""Run parameters."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

_RENAMED = {"num_epochs": "max_steps"}


@dataclass(frozen=True)
class Params:
    """One training run. Defaults are fixed values of the untuned run."""

    test_p: float = 0.10
    valid_p: float = 0.20
    optimiser: str = "Adam"
    loss: str = "binary_cross_entropy"
    num_node_features: int = 15
    num_hidden_graph_layers: int = 20
    num_negative_samples: int = 10
    batch_size: int = 12
    max_steps: int = 200
    lr: float = 0.001
    l2_regularisation: float = 0.0005
    momentum: float = 0.05
    aggregator_type: str = "mean"
    fanouts: tuple[int, int] = (4, 4)
    batches_per_step: int = 1
    exclude_seed_edges: bool = False
    strict_negatives: bool = False
    seed: int = 7

    @classmethod
    def from_mapping(cls, values: Mapping) -> Params:
        """Parameters from a flat mapping such as a parsed configuration file.

        ``num_epochs`` is the number of steps; keys of devices, workers, classes
        and databases have no meaning here and are passed over.
        """
        renamed = {_RENAMED.get(k, k): v for k, v in values.items()}
        known = {f.name: f.type for f in fields(cls)}
        casts = {"int": int, "float": float, "bool": _truth}
        return cls(**{k: casts.get(known[k], lambda x: x)(v) for k, v in renamed.items() if k in known})

    def with_changes(self, **changes) -> Params:
        return replace(self, **changes)


def _truth(value: object) -> bool:
    """A switch from a configuration file, where it may be text."""
    text = str(value).strip().lower()
    if text not in ("true", "false", "1", "0"):
        raise ValueError(f"not a switch: {value!r}")
    return text in ("true", "1")


# The tuned parameters documented for the published run.
TUNED = Params(
    optimiser="SGD",
    loss="margin",
    num_node_features=50,
    num_hidden_graph_layers=100,
    num_negative_samples=50,
    batch_size=32,
    max_steps=2000,
    lr=0.01,
    l2_regularisation=0.005,
    momentum=0.005,
    aggregator_type="pool",
)
