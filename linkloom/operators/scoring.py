"""Link scores from node embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.vectors import dot, linear, sigmoid
from linkloom.model import SageModel


def endpoint_pairs(edges: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Every edge with both endpoint vectors, ``h_u`` and ``h_v``."""
    u = embeddings.select(F.col("id").alias("src"), F.col("x").alias("h_u"))
    v = embeddings.select(F.col("id").alias("dst"), F.col("x").alias("h_v"))
    return edges.join(u, "src").join(v, "dst")


def dot_link_score(edges: DataFrame, embeddings: DataFrame, width: int) -> DataFrame:
    """Edges with ``score``, the sigmoid of the endpoints' inner product."""
    scored = endpoint_pairs(edges, embeddings)
    product = dot(F.col("h_u"), F.col("h_v"), width)
    return scored.withColumn("score", sigmoid(product)).drop("h_u", "h_v")


def endpoint_scores(embeddings: DataFrame, model: SageModel, keys: tuple[str, ...] = ()) -> DataFrame:
    """Each node's share of a link score as source and as destination."""
    w_u, w_v, _ = model.head
    both = embeddings.select(*keys, "id", linear(F.col("x"), np.stack([w_u, w_v])).alias("s"))
    return both.select(*keys, "id", F.col("s")[0].alias("as_src"), F.col("s")[1].alias("as_dst"))


def mlp_link_score(
    edges: DataFrame,
    embeddings: DataFrame,
    model: SageModel,
    keys: tuple[str, ...] = (),
    how: str = "inner",
) -> DataFrame:
    """Edges with the classifier's raw ``score``, ``w . [h_u; h_v] + b``.

    The product splits into one number per endpoint, so numbers meet in the
    joins and not vectors.
    """
    shares = endpoint_scores(embeddings, model, keys)
    u = shares.select(*keys, F.col("id").alias("src"), "as_src")
    v = shares.select(*keys, F.col("id").alias("dst"), "as_dst")
    scored = edges.join(u, [*keys, "src"], how).join(v, [*keys, "dst"], how)
    score = F.col("as_src") + F.col("as_dst") + F.lit(model.head[2])
    return scored.withColumn("score", score).drop("as_src", "as_dst")


def predict_links(relations: DataFrame, embeddings: DataFrame, model: SageModel) -> DataFrame:
    """Relations with ``gnn_prediction``; null where an endpoint has no embedding."""
    named = relations.withColumn("src", F.col("src_id")).withColumn("dst", F.col("dst_id"))
    scored = mlp_link_score(named, embeddings, model, how="left")
    return scored.withColumn("gnn_prediction", sigmoid(F.col("score"))).drop("src", "dst", "score")
