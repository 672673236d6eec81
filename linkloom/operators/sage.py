"""GraphSAGE layers as joins and aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.functions.vectors import affine, linear, zeros
from linkloom.model import SageLayer, SageModel
from linkloom.operators.graph import parallel_counts
from linkloom.session import materialise


def gather_features(links: DataFrame, nodes: DataFrame, vector: str = "x") -> DataFrame:
    """Every link with the feature vector of its source."""
    return links.join(nodes.select(F.col("id").alias("src"), vector), "src")


def neighbour_mean(
    messages: DataFrame, keys: list[str], width: int, vector: str = "x"
) -> DataFrame:
    """Element-wise mean of ``messages`` per ``keys``, weighted by ``n`` when present.

    One running sum per element: rows stay one per message, and hubs are folded
    by partial aggregates before the shuffle.
    """
    n = F.col("n") if "n" in messages.columns else F.lit(1)
    sums = [F.sum(F.col(vector)[i] * n).alias(f"_{i}") for i in range(width)]
    folded = messages.groupBy(*keys).agg(F.sum(n).alias("_n"), *sums)
    return folded.select(*keys, F.array(*[F.col(f"_{i}") / F.col("_n") for i in range(width)]).alias("agg"))


def neighbour_max(
    messages: DataFrame, keys: list[str], width: int, vector: str = "x"
) -> DataFrame:
    """Element-wise maximum of ``messages`` per ``keys``."""
    tops = [F.max(F.col(vector)[i]).alias(f"_{i}") for i in range(width)]
    folded = messages.groupBy(*keys).agg(*tops)
    return folded.select(*keys, F.array(*[F.col(f"_{i}") for i in range(width)]).alias("agg"))


def pool_transform(nodes: DataFrame, weight: np.ndarray, bias: np.ndarray) -> DataFrame:
    """The non-linear map applied to every node before pooling."""
    return nodes.withColumn("x", linear(F.col("x"), weight, bias, activate=True))


def neighbour_pool(
    links: DataFrame, nodes: DataFrame, weight: np.ndarray, bias: np.ndarray, how: str = "max"
) -> DataFrame:
    """Maximum (or mean) over each destination's transformed source vectors."""
    messages = gather_features(links, pool_transform(nodes, weight, bias))
    fold = neighbour_max if how == "max" else neighbour_mean
    return fold(messages, ["dst"], weight.shape[0])


def sage_layer(
    links: DataFrame, nodes: DataFrame, layer: SageLayer, activate: bool, keys: tuple[str, ...] = ()
) -> DataFrame:
    """One convolution: ``W_self h + W_neigh agg(neighbours) + b``.

    ``links(*keys, src, dst[, n])`` carry messages, ``nodes(*keys, id, x)`` are the
    inputs; extra ``keys`` (a batch id) keep separate message graphs apart. Nodes
    without in-links get a zero neighbour vector. For means the narrower side of
    ``W_neigh`` travels: it is applied before the shuffle when that shrinks vectors.
    """
    before = layer.kind == "mean" and layer.out_width < layer.in_width
    messages, width = nodes, layer.in_width
    if before:
        messages = nodes.withColumn("x", linear(F.col("x"), layer.neigh))
        width = layer.out_width
    elif layer.kind != "mean":
        messages = pool_transform(nodes, layer.pool, layer.pool_bias)
    sources = messages.select(*keys, F.col("id").alias("src"), "x")
    gathered = links.join(sources, [*keys, "src"])
    fold = neighbour_max if layer.kind == "pool" else neighbour_mean
    folded = fold(gathered, [*keys, "dst"], width).withColumnRenamed("dst", "id")

    both = nodes.join(folded, [*keys, "id"], "left").withColumn(
        "agg", F.coalesce("agg", zeros(width))
    )
    terms = [(F.col("x"), layer.self_), (F.col("agg"), None if before else layer.neigh)]
    return both.select(*keys, "id", affine(terms, layer.bias, activate).alias("x"))


def embed_all(
    edges: DataFrame, nodes: DataFrame, model: SageModel, final_relu: bool = True
) -> DataFrame:
    """Embeddings ``(id, x)`` of every node from all of its neighbours, layer by layer.

    The first layer is written, as the second reads it twice.
    """
    links = materialise(parallel_counts(edges), "links")
    hidden = materialise(sage_layer(links, nodes, model.first, True), "hidden")
    return sage_layer(links, hidden, model.second, final_relu)


def encode_blocks(blocks: DataFrame, inputs: DataFrame, seeds: DataFrame, model: SageModel) -> DataFrame:
    """Embeddings ``(batch_id, id, x)`` of each batch's seeds from its sampled blocks.

    ``inputs(id, x)`` are the node features. The last layer is not activated.
    """
    outer = blocks.filter("layer = 2").select("batch_id", "src", "dst")
    inner = blocks.filter("layer = 1").select("batch_id", "src", "dst")
    reached = seeds.unionByName(outer.select("batch_id", F.col("src").alias("id"))).distinct()
    read = reached.unionByName(inner.select("batch_id", F.col("src").alias("id"))).distinct()
    x = read.join(inputs.select("id", "x"), "id").select("batch_id", "id", "x")
    hidden = sage_layer(inner, x, model.first, True, ("batch_id",))
    hidden = materialise(hidden, "hidden")
    return sage_layer(outer, hidden, model.second, False, ("batch_id",)).join(
        seeds, ["batch_id", "id"], "left_semi"
    )

