"""Gold tables: scored and refined relations."""

from __future__ import annotations

from pyspark.sql import DataFrame

from linkloom.model import SageModel
from linkloom.operators.graph import node_features
from linkloom.operators.recommend import unscored_links
from linkloom.operators.refine import clean_parties, refine_probability
from linkloom.operators.sage import embed_all
from linkloom.operators.scoring import predict_links
from linkloom.session import materialise


def score_relations(
    silver: DataFrame,
    embeddings: DataFrame,
    model: SageModel,
    bronze: DataFrame | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Silver with ``gnn_prediction``; given bronze, the links silver left out are scored too."""
    relations = silver
    if bronze is not None:
        relations = silver.unionByName(clean_parties(unscored_links(bronze, silver, keys)))
    return predict_links(relations, embeddings, model)


def stored_embeddings(
    edges: DataFrame, nodes: DataFrame, model: SageModel, seed: int
) -> DataFrame:
    """Full-neighbour embeddings for scoring, written once; no last activation, as in training."""
    x = materialise(node_features(nodes, model.first.in_width, seed), "features")
    return materialise(embed_all(edges, x, model, final_relu=False), "embeddings")


def refined_gold(predictions: DataFrame) -> DataFrame:
    return refine_probability(predictions)
