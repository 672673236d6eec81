"""One whole run: relations in; weights, metrics, evaluation and projection out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.config import Params
from linkloom.model import save_model
from linkloom.operators.graph import build_edges, count_nodes, node_features
from linkloom.operators.ordering import split_edges
from linkloom.operators.sage import embed_all
from linkloom.plans.batches import at_once, edge_batches, pack_batches
from linkloom.plans.evaluate import embedding_projection, evaluate, packed_forward
from linkloom.plans.lockstep import TrainingRun
from linkloom.plans.train import metric_rows, train
from linkloom.session import materialise


@dataclass(frozen=True)
class FinishedRun:
    training: TrainingRun
    evaluation: DataFrame
    n_nodes: int


def train_and_evaluate(
    relations: DataFrame, keys: list[str], params: Params, output: str, run_id: str = "run"
) -> FinishedRun:
    """Split, train on the training edges, evaluate both held-out splits, write it all.

    ``output`` gets ``model``, ``metrics``, ``evaluation`` and ``projection``. Runs share the
    table of metrics, each in a folder by its id; a run that is tried again replaces its rows.
    """
    spark = relations.sparkSession
    edges = build_edges(relations, keys)
    labelled = split_edges(edges, edges.count(), params.test_p, params.valid_p)
    labelled = materialise(labelled, "edges", ("split",))
    n_nodes = count_nodes(labelled)
    x = materialise(
        node_features(spark.range(n_nodes), params.num_node_features, params.seed), "features"
    )

    def edges_of(split: str) -> DataFrame:
        return labelled.filter(F.col("split") == split).drop("split")

    def packed(split: str) -> DataFrame:
        return pack_batches(edge_batches(edges_of(split), n_nodes, params, split == "training"), None, params)

    splits = "training", "validation", "testing"
    tables = dict(zip(splits, at_once(spark, *(lambda s=s: packed(s) for s in splits))))
    training = train(tables["training"], params)
    model = training.model
    save_model(spark, model, f"{output}/model")
    # A folder for each run, written anew when the run is tried again.
    metric_rows(spark, run_id, training).drop("run_id").write.mode("overwrite").parquet(f"{output}/metrics/run_id={run_id}")

    scores = {s: packed_forward(tables[s], model, params.fanouts, params.seed) for s in splits[1:]}
    evaluate(scores).write.mode("overwrite").parquet(f"{output}/evaluation")

    h = materialise(embed_all(edges_of("training"), x, model), "embeddings")
    embedding_projection(h).write.mode("overwrite").parquet(f"{output}/projection")
    return FinishedRun(training, spark.read.parquet(f"{output}/evaluation"), n_nodes)
